"""Size, capacity and hot-key reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexitab.functions.text import json_text, row_bytes, utf8_bytes
from lexitab.schema import HEADER_BYTES, JSON_BEGIN, JSON_END, JSON_ENTRY, JSON_INDENT, JSON_LINE

# Bytes of offset, length and overhead per entry in the capacity model.
ENTRY_BYTES = 8 + 4 + 6
VERSIONS_KEPT = 2


def _index_bytes() -> Column:
    return F.coalesce(F.sum(utf8_bytes("title") + ENTRY_BYTES), F.lit(0)).cast("long")


def _data_bytes() -> Column:
    return (F.coalesce(F.sum(row_bytes().cast("long")), F.lit(0)) + HEADER_BYTES).cast("long")


def size_report(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        _data_bytes().alias("data_bytes"),
        F.coalesce(F.sum(utf8_bytes("title")), F.lit(0)).cast("long").alias("title_bytes"),
    ).withColumn("data_mb", F.col("data_bytes") / (1024 ** 2)) \
     .withColumn("data_gb", F.col("data_bytes") / (1024 ** 3))


def json_index_bytes(entries: DataFrame) -> DataFrame:
    """``(index_json_bytes)``: what ``sinks.files.write_index_json`` takes for these entries, without writing it."""
    digits = F.length(F.col("byte_offset").cast("string")) + F.length(F.col("byte_length").cast("string"))
    each = F.sum(F.octet_length(json_text("title")) + digits + len(JSON_ENTRY.replace("%d", "")) + len(JSON_INDENT) + len(JSON_LINE))
    # Commas stand between entries; the object begins with a line of its own and ends with one.
    return entries.agg(F.coalesce(each + F.count(F.lit(1)) - 1 + len(JSON_BEGIN) + len(JSON_END), F.lit(0)).cast("long").alias("index_json_bytes"))


def capacity_estimate(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Index model bytes, the exact bytes of the JSON index of ``entries``, and the storage of one version
    and of both blue-green versions by the model."""
    json_bytes = json_index_bytes(entries).first()[0]
    return rows.agg(
        F.count(F.lit(1)).alias("keys"), _index_bytes().alias("index_bytes"), _data_bytes().alias("data_bytes"),
    ).withColumn("index_json_bytes", F.lit(json_bytes).cast("long")) \
     .withColumn("version_bytes", F.col("index_bytes") + F.col("data_bytes")) \
     .withColumn("storage_bytes", F.col("version_bytes") * VERSIONS_KEPT)


def hot_keys(requests: DataFrame, k: int) -> DataFrame:
    """The ``k`` most requested keys; counts are combined before the shuffle."""
    return (requests.groupBy("key").agg(F.count(F.lit(1)).alias("requests"))
            .orderBy(F.desc("requests"), "key").limit(k))
