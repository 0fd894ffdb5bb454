"""Copy-on-write versions: an update rewrites only the files that meet a key of the changelog.

A version is a list of files, most of them written by earlier versions.  Each file holds a range of keys
and has its index entries, with offsets in the file, beside it; where a file begins in the whole is a sum
over the list.  So an update of few keys reads and writes few files, moves no offset of any other, and the
list, with one row per file, is all that is written anew.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from lexitab.operators import ranges
from lexitab.operators.index import last_wins
from lexitab.functions.text import row_bytes
from lexitab.operators.merge import upsert
from lexitab.operators.ordering import number_rows, range_sort, with_key
from lexitab.plans.build import MANIFEST_FILE, VERSIONS, claim_version, load_manifest, stamps, switch_manifest
from lexitab.schema import DICT
from lexitab.session import materialise, write_table
from lexitab.sources.files import DATA

ROWS, ENTRIES, FILES = "rows.parquet", "entries.parquet", "files.parquet"
ENTRY = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("file", T.StringType()), T.StructField("row", T.LongType()),
    T.StructField("file_offset", T.LongType()), T.StructField("byte_length", T.IntegerType())])


@dataclass
class Update:
    """What an update did: the version, its files, and how many of them it read and wrote."""

    version: str
    files: int
    read: int
    written: int
    rows: int
    bytes: int


def _relative(root: str):
    """A file's path below the root, from a reader's metadata."""
    return F.regexp_extract("_metadata.file_path", f"({VERSIONS}/[^/]+/{ROWS}/.*)$", 1)


def _write_rows(spark: SparkSession, root: str, version: str, rows: DataFrame, num_parts: int | None) -> DataFrame:
    """Write ``(title, value, k, side, ord, region)`` rows sorted, no file across two regions; list the files.

    Returns ``(region, pid, file, first, last, rows, bytes)`` and writes the files' index entries.
    """
    home = os.path.join(root, VERSIONS, version)
    ordered = range_sort(rows, ["region", "k", "side", "ord"], num_parts).withColumn("byte_length", row_bytes())
    number_rows(ordered).select(*DATA.names, "region").write.partitionBy("region").option("compression", "zstd").parquet(os.path.join(home, ROWS))
    slim = spark.read.schema(T.StructType([*DATA.fields, T.StructField("region", T.IntegerType())])).parquet(os.path.join(home, ROWS)).select(
        "region", "pid", "row", "title", "k", "byte_length", _relative(root).alias("file"))
    before = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("byte_length").over(before), F.lit(0)).cast("long")
    write_table(slim.select("title", "file", "row", offset.alias("file_offset"), "byte_length"), os.path.join(home, ENTRIES))
    return slim.groupBy("region", "pid", "file").agg(
        F.min("k").alias("first"), F.max("k").alias("last"), F.count(F.lit(1)).alias("rows"), F.sum("byte_length").alias("bytes"))


def _write_list(root: str, version: str, listed: DataFrame) -> DataFrame:
    """Number files by ``(at, pid)`` and write the list: one row per file goes through the window."""
    seq = F.row_number().over(Window.orderBy("at", "pid")) - 1
    files = listed.select(seq.alias("seq"), "file", "first", "last", "rows", "bytes")
    return write_table(files, os.path.join(root, VERSIONS, version, FILES))


def snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The live version's files, named by the manifest."""
    return spark.read.parquet(os.path.join(root, load_manifest(spark, root)["file_path"]))


def _rows_of(spark: SparkSession, root: str, files: list[str]) -> DataFrame:
    """Rows of some files, with the file that each is in; no other file is opened."""
    if not files:
        return spark.createDataFrame([], T.StructType([*DATA.fields, T.StructField("file", T.StringType())]))
    return spark.read.schema(DATA).parquet(*(os.path.join(root, f) for f in files)).select(*DATA.names, _relative(root).alias("file"))


def rows(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the live version: ``(title, value, k, byte_length, seq, row)``, in the order of the last two."""
    files = snapshot(spark, root)
    read = _rows_of(spark, root, [r.file for r in files.select("file").collect()])
    return read.join(files.select("file", "seq"), "file").select("title", "value", "k", "byte_length", "seq", "row")


def entries(spark: SparkSession, root: str, files: DataFrame | None = None) -> DataFrame:
    """Index entries of the live version's files, or of some of them; offsets are in the file."""
    files = snapshot(spark, root) if files is None else files
    homes = [r[0] for r in files.select(F.regexp_extract("file", f"^({VERSIONS}/[^/]+)/", 1)).distinct().collect()]
    if not homes:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(*(os.path.join(root, home, ENTRIES) for home in homes)).join(files.select("file"), "file", "left_semi")


def index(spark: SparkSession, root: str) -> DataFrame:
    """``(title, byte_offset, byte_length)`` of every row of the live version."""
    return ranges.two_level_index(entries(spark, root), snapshot(spark, root))


def live_entries(spark: SparkSession, root: str) -> DataFrame:
    """One index entry per exact title, the last row winning."""
    return last_wins(index(spark, root))


def _publish(spark: SparkSession, root: str, version: str, iso: str, files: DataFrame, manifest: dict, seen: dict,
             read: int, written: int, expected: int | None) -> Update:
    count, total, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    ends = entries(spark, root, files).groupBy("file").agg(F.max(F.col("file_offset") + F.col("byte_length")).alias("end"), F.count(F.lit(1)).alias("n"))
    wrong = files.join(ends, "file", "left").filter("end is null or end <> bytes or n <> rows").limit(1).collect()
    if wrong or (expected is not None and expected != total):
        raise RuntimeError(f"{version} does not hold what was merged: {wrong or (total, expected)}")
    home = f"{VERSIONS}/{version}"
    manifest = manifest | {"file_path": f"{home}/{FILES}", "index_file_path": f"{home}/{ENTRIES}", "last_updated_at": iso, "version": version}
    switch_manifest(spark, os.path.join(root, MANIFEST_FILE), manifest, seen)
    return Update(version, count, read, written, total, size)


def create(spark: SparkSession, root: str, source: DataFrame, *, now: datetime | None = None, num_parts: int | None = None) -> Update:
    """Publish ``(title, value, ord)`` rows as a first version of sorted files."""
    stamp, iso = stamps(spark, now)
    seen = load_manifest(spark, root)
    version = claim_version(spark, root, stamp)
    whole = with_key(source).select(*DICT.names, "k", F.lit(0).alias("side"), "ord", F.lit(0).alias("region"))
    made = materialise(_write_rows(spark, root, version, whole, num_parts).withColumn("at", F.lit(0)), "files")
    files = _write_list(root, version, made)
    return _publish(spark, root, version, iso, files, seen, seen, 0, made.count(), None)


def update(spark: SparkSession, root: str, changelog: DataFrame, *, now: datetime | None = None, num_parts: int | None = None) -> Update:
    """Upsert ``(title, value, ord)`` rows into the live version, rewriting only the files they meet.

    Semantics are those of ``merge.upsert``: all files that hold rows of a changelog's key are read
    together, so its pairs are those of the whole table.  Neighbours that are both rewritten may exchange
    rows at their border; no new file reaches over one that stays.  A changelog without rows lists the same
    files again.
    """
    seen = load_manifest(spark, root)
    if not seen.get("file_path"):
        raise ValueError("missing or empty required manifest field: file_path")
    stamp, iso = stamps(spark, now)
    changelog = with_key(materialise(changelog.select(*DICT.names, "ord"), "changelog"))
    files = snapshot(spark, root)
    # One row per file, as in any listing.
    listed = files.orderBy("seq").collect()
    routed = materialise(ranges.route(changelog, [(f["first"], f["last"]) for f in listed]), "routes")
    region = ranges.regions([s for s in ranges.touched(routed) if s < len(listed)])
    some = [listed[s] for s in region]
    seqs = spark.createDataFrame([(f.file, f.seq, region[f.seq]) for f in some], "file string, seq int, region int")
    existing = _rows_of(spark, root, [f.file for f in some]).join(seqs, "file").select(
        *DICT.names, F.struct(F.format_string("p%010d", "seq").alias("file"), F.lit(0).cast("long").alias("block"), F.col("row")).alias("ord"), "region")
    by_seq = spark.createDataFrame(sorted(region.items()) or [(0, 0)], "lo int, region int")
    incoming = changelog.join(routed.join(by_seq, "lo").select("k", "region"), "k").select(*DICT.names, "ord", "region")
    version = claim_version(spark, root, stamp)
    merged = upsert(existing, incoming, "region")
    made = materialise(_write_rows(spark, root, version, merged, num_parts).withColumn("at", F.col("region")), "files")
    kept = files.filter(~F.col("seq").isin(list(region))) if region else files
    new = _write_list(root, version, kept.withColumns({"at": F.col("seq"), "pid": F.lit(0)}).select("at", "pid", "file", "first", "last", "rows", "bytes")
                      .unionByName(made.select("at", "pid", "file", "first", "last", "rows", "bytes")))
    return _publish(spark, root, version, iso, new, seen, seen, len(some), made.count(), None)
