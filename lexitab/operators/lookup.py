"""Batch key lookup, byte-range fetch and prefix search."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lexitab.functions.text import csv_decode
from lexitab.operators.ordering import number_rows, range_sort, with_positions
from lexitab.session import materialise
from lexitab.sources.listing import listed_files

# Ranges of one file this close together are read as one.
GAP_BYTES = 64 * 1024
# Bytes that are read at a time, unless one row is longer.
READ_BYTES = 8 * 1024 ** 2
# Titles that one window of the prefix index goes over.
BLOCK = 1 << 18


def latest_values(merged: DataFrame) -> DataFrame:
    """One row per exact title of a merged table: the last in its output order.

    ``row_number() = 1`` lets Spark drop earlier rows before the shuffle.
    """
    order = Window.partitionBy("title").orderBy(F.desc("side"), F.desc("ord"))
    return (merged.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1")
            .select("title", "value"))


def lookup(requests: DataFrame, table: DataFrame) -> DataFrame:
    """Exact, case-sensitive lookup of ``requests.key`` in a table with unique ``title``.

    Every request gives one row; a miss has ``found = false`` and NULL in the table's columns.  The
    table is cut to the keys that are asked for before its values move.  What is left is unique per
    key, so a hot key is on the requests' side only, where Spark can split it.
    """
    asked = requests.select("key").distinct()
    found = table.withColumnRenamed("title", "key").join(asked, "key", "left_semi").withColumn("_hit", F.lit(True))
    joined = requests.join(found, "key", "left")
    return joined.withColumn("found", F.coalesce("_hit", F.lit(False))).drop("_hit")


def misses(requests: DataFrame, table: DataFrame) -> DataFrame:
    """Requested keys the table does not hold, with their request counts.

    Both sides are reduced to one row per key before they meet.
    """
    asked = requests.groupBy("key").agg(F.count(F.lit(1)).alias("requests"))
    return asked.join(table.select(F.col("title").alias("key")).distinct(), "key", "left_anti")


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Read the asked ranges of each file; rows come sorted by file and offset.

    Neighbouring ranges are one read, of bounded size.  Only what is asked for, and small gaps, is read.
    """
    for batch in batches:
        rows = batch.to_pylist()
        first = 0
        while first < len(rows):
            path, start = rows[first]["file_path"], rows[first]["part_offset"]
            end, last = start + rows[first]["byte_length"], first + 1
            while (last < len(rows) and rows[last]["file_path"] == path and rows[last]["part_offset"] <= end + GAP_BYTES
                   and rows[last]["part_offset"] + rows[last]["byte_length"] <= start + READ_BYTES):
                end = max(end, rows[last]["part_offset"] + rows[last]["byte_length"])
                last += 1
            store, name = pafs.FileSystem.from_uri(path)
            with store.open_input_file(name) as file:
                data = file.read_at(end - start, start)
            some = rows[first:last]
            cut = [data[r["part_offset"] - start:r["part_offset"] - start + r["byte_length"]] for r in some]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([r[n] for r in some], batch.schema.field(n).type) for n in ("title", "byte_offset", "byte_length")),
                 pa.array(cut, pa.binary())], ["title", "byte_offset", "byte_length", "bytes"])
            first = last


def fetch_slices(spark: SparkSession, index: DataFrame, csv_path: str) -> DataFrame:
    """Read ``[part_offset, part_offset + byte_length)`` of each entry's part and decode it.

    The entries, which are slim, go to the tasks that read: one range exchange by file and offset, so
    a part that many ask for is read by several tasks.  No content is in an exchange and nothing but
    the asked ranges is read.  The parts' store has to be one that Arrow opens by URI.
    """
    files = listed_files(spark, csv_path, "*.txt").withColumn(
        "part_file", F.regexp_extract("file_path", "part_file=([^/]+)/", 1))
    placed = index.join(files.select("part_file", "file_path"), "part_file").select(
        "title", "byte_offset", "byte_length", "file_path", "part_offset")
    ordered = placed.repartitionByRange("file_path", "part_offset").sortWithinPartitions("file_path", "part_offset")
    sliced = ordered.mapInArrow(_read_ranges, "title string, byte_offset bigint, byte_length int, bytes binary")
    # As a generator the decoded row is made once, not once for each of its fields.
    decoded = F.inline(F.array(csv_decode(F.col("bytes").cast("string"))))
    return sliced.select("title", "byte_offset", "byte_length", decoded.alias("slice_title", "slice_value"))


def read_values(spark: SparkSession, requests: DataFrame, index: DataFrame, csv_path: str) -> DataFrame:
    """The whole read path in batch: key, index entry, byte range, value.

    Each requested title is fetched once, however often it is asked for.
    """
    asked = requests.select(F.col("key").alias("title")).distinct()
    entries = index.join(asked, "title", "left_semi")
    values = fetch_slices(spark, entries, csv_path).select("title", F.col("slice_value").alias("value"))
    return lookup(requests, values)


def prefix_search(table: DataFrame, prefix: str, k: int) -> DataFrame:
    """The first ``k`` titles that start with ``prefix``, ignoring case.

    On a published table the filter on its stored ``k`` column is pushed into the scan.
    """
    key = F.col("k") if "k" in table.columns else F.lower("title")
    return (table.filter(key.startswith(prefix.lower())).select("title", "value", key.alias("k"))
            .orderBy("k", "title", "value").limit(k).drop("k"))


def prefix_index(table: DataFrame, max_len: int, k: int) -> DataFrame:
    """The first ``k`` distinct titles of every folded prefix of up to ``max_len`` characters.

    In sorted order the titles of a prefix are neighbours, so a title's rank is its distance from where the
    prefix began, which shows where a title's prefix differs from the one before.  Titles are sorted once
    and numbered; blocks of positions look ahead in one pass, each with the last ``k`` titles of the block
    before it.  A prefix that began earlier than these has more than ``k`` titles by then, so nothing else
    is needed, for any ``k`` and however many titles share a prefix.
    """
    key = F.lower("title")
    titles = table.select("title").distinct().select("title", key.alias("key")).filter(F.length("key") > 0)
    sorted_titles = with_positions(materialise(number_rows(range_sort(titles, ["key", "title"])), "titles"))
    size = max(BLOCK, k)
    own = F.floor(F.col("pos") / size)
    blocks = F.when(F.col("pos") % size >= size - k, F.array(own, own + 1)).otherwise(F.array(own))
    rows = sorted_titles.select("title", "key", "pos", F.explode(blocks).alias("block"))
    in_block = Window.partitionBy("block").orderBy("pos")
    rows = rows.withColumn("before", F.lag("key").over(in_block))
    upto = in_block.rowsBetween(Window.unboundedPreceding, 0)

    def began(n: int) -> Column:
        begins = (F.col("pos") == 0) | (F.substring("key", 1, n) != F.substring("before", 1, n))
        return F.last(F.when(begins, F.col("pos")), ignorenulls=True).over(upto)

    rows = rows.select("title", "key", "pos", "block", F.array(*(
        F.struct(F.lit(n).alias("n"), (F.col("pos") - began(n) + 1).cast("int").alias("rank")) for n in range(1, max_len + 1))).alias("ranks"))
    ranked = F.filter("ranks", lambda r: (r["rank"] <= k) & (r["n"] <= F.length("key")))
    return rows.filter(F.col("pos") >= F.col("block") * size).select("title", "key", F.inline(ranked)).select(
        F.substring("key", F.lit(1), F.col("n")).alias("prefix"), "rank", "title")


def complete(requests: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Completions for a table of ``(request_id, prefix)`` by an equi-join to ``prefix_index``.

    The index has at most its ``k`` rows per prefix, so a hot prefix is on the requests' side only.
    """
    return requests.withColumn("prefix", F.lower("prefix")).join(prefixes, "prefix", "left")
