"""Table layouts shared by every job."""

from pyspark.sql import types as T

DICT = T.StructType([
    T.StructField("title", T.StringType(), False),
    T.StructField("value", T.StringType(), False),
])

MANIFEST = T.StructType([
    T.StructField(name, T.StringType())
    for name in (
        "service_name", "service_description", "service_author", "file_path",
        "index_file_path", "changelog_file_path", "last_updated_at", "version",
    )
])

# Fixed value: length in bytes of the header line "title,value\r\n".
HEADER = "title,value"
HEADER_BYTES = 13

# The layout of the JSON index.
JSON_BEGIN, JSON_END, JSON_LINE, JSON_INDENT = "{\n", "\n}", "\n", "  "
JSON_ENTRY = ': {\n    "offset": %d,\n    "length": %d\n  }'
