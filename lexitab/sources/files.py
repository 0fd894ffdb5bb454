"""Readers for dictionary CSV, raw lines, manifests and published tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from lexitab.schema import DICT, MANIFEST


def read_dictionary(spark: SparkSession, path: str, multi_line: bool = True,
                    header: bool = True) -> DataFrame:
    """A dictionary or changelog CSV as ``(title, value, ord)``.

    Columns go by header name; missing fields are empty and extra ones dropped; a line end
    inside quotes becomes ``\\n``.  All files of a folder need the same header: one that differs is an
    error when it is read, as Spark would take its columns by their place.  ``ord`` is (file, split,
    row).  ``multi_line=False`` lets Spark split large files whose values hold no line ends;
    ``header=False`` reads CSV parts.
    """
    reader = spark.read.options(escape='"', header=header, multiLine=multi_line, enforceSchema=False)
    raw = reader.schema(reader.csv(path).schema).csv(path) if header else reader.schema(DICT).csv(path)
    return raw.select(
        *(F.regexp_replace(F.coalesce(name, F.lit("")), "\r\n?", "\n").alias(name) for name in DICT.names),
        F.struct(F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("ord"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines split only at ``\\n``, with what is needed to place them in their file."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("line_id"))


def read_part_lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines of the CSV parts below ``path``, each with the name of its part."""
    return spark.read.options(lineSep="\n", pathGlobFilter="*.txt").text(path).select(
        "value", "part_file",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest as one row; no row if the file does not exist.  Other errors are raised."""
    try:
        return spark.read.schema(MANIFEST).option("mode", "FAILFAST").json(path, multiLine=True)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], MANIFEST)
        raise


DATA = T.StructType([
    *DICT.fields,
    T.StructField("k", T.StringType()),
    T.StructField("byte_length", T.IntegerType()),
    T.StructField("pid", T.IntegerType()),
    T.StructField("row", T.LongType()),
])


def read_data(spark: SparkSession, path: str) -> DataFrame:
    """A published data table."""
    return spark.read.schema(DATA).parquet(path)


def as_dictionary(data: DataFrame) -> DataFrame:
    """A published table as merge input; ``ord`` has the type that CSV input has."""
    return data.select("title", "value", F.struct(
        F.format_string("p%010d", "pid").alias("file"), F.lit(0).cast("long").alias("block"),
        F.col("row")).alias("ord"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_index_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON index in parts as ``(title, byte_offset, byte_length)``.

    A part is a piece of one object; with its ends trimmed and braces around it, it is an object.
    """
    parts = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    body = F.regexp_replace(F.regexp_replace("value", r"^\{\n", ""), r"(,|\n\})?\n$", "")
    entries = F.from_json(F.concat(F.lit("{"), body, F.lit("}")), "map<string, struct<offset: bigint, length: int>>")
    return parts.select(F.explode(entries).alias("title", "e")).select(
        "title", F.col("e.offset").alias("byte_offset"), F.col("e.length").alias("byte_length"))
