"""An index whose files are found by key before any is opened.

Entries are sorted by title and each file is a shard of its own, a partition column with its first and
last title in a small table.  Requests get their shard by binary search, the scan is cut to these shards,
and inside them Bloom filters on the title let a reader skip row groups that lack it.
"""

from __future__ import annotations

import os
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexitab.operators.lookup import lookup
from lexitab.operators.ordering import number_rows, range_sort
from lexitab.operators.ranges import route
from lexitab.session import write_table

ENTRIES, BOUNDS = "entries.parquet", "bounds.parquet"
# Titles are unique, so a dictionary of them would only keep the Bloom filters from being written.
BLOOM = {"parquet.bloom.filter.enabled#title": "true", "parquet.bloom.filter.fpp#title": "0.01",
         "parquet.enable.dictionary#title": "false", "compression": "zstd"}
# Keys that go into the scan itself; more are looked up by a join.
KNOWN_KEYS = 200


def write_routed(index: DataFrame, path: str, num_parts: int | None = None, **options: str) -> None:
    """Write entries with unique ``title`` as shards, and their bounds: one row per shard."""
    ordered = number_rows(range_sort(index, ["title"], num_parts)).drop("row").withColumnRenamed("pid", "shard")
    ordered.write.partitionBy("shard").options(**{**BLOOM, **options}).parquet(os.path.join(path, ENTRIES))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema)
    written = index.sparkSession.read.schema(schema).parquet(os.path.join(path, ENTRIES))
    bounds = written.groupBy("shard").agg(F.min("title").alias("first"), F.max("title").alias("last"), F.count(F.lit(1)).alias("entries"))
    write_table(bounds, os.path.join(path, BOUNDS))


def _shards(spark: SparkSession, path: str) -> list:
    """One row per shard, in the order of their titles."""
    return spark.read.parquet(os.path.join(path, BOUNDS)).orderBy("first").collect()


def _entries(spark: SparkSession, path: str, shards: list[int]) -> DataFrame:
    entries = spark.read.parquet(os.path.join(path, ENTRIES))
    return entries.filter(F.col("shard").isin(shards)).drop("shard")


def routed_lookup(requests: DataFrame, path: str) -> DataFrame:
    """``operators.lookup.lookup`` that opens only the shards some request falls into.

    Keys are routed as slim rows; what reaches the driver is the list of shards, as in any file listing.
    """
    spark = requests.sparkSession
    bounds = _shards(spark, path)
    if not bounds:
        return lookup(requests, spark.read.parquet(os.path.join(path, BOUNDS)).limit(0).select(F.col("first").alias("title")))
    keys = requests.select(F.col("key").alias("k")).filter("k is not null")
    routed = route(keys, [(b["first"], b["last"]) for b in bounds]).select("lo").distinct().collect()
    return lookup(requests, _entries(spark, path, sorted(bounds[r.lo]["shard"] for r in routed)))


def find(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Entries of a few keys that are known before the scan: ``(title, ...)`` of those that exist.

    Each key is compared in the scan, so shards, row groups and their Bloom filters are asked for it first.
    """
    if len(keys) > KNOWN_KEYS:
        raise ValueError(f"more than {KNOWN_KEYS} keys: use routed_lookup")
    bounds = _shards(spark, path)
    hit = [b["shard"] for b in bounds if any(b["first"] <= key <= b["last"] for key in keys)]
    entries = _entries(spark, path, hit)
    return entries.filter(reduce(or_, (F.col("title") == key for key in keys), F.lit(False)))
