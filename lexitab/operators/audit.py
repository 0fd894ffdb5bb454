"""Digests of what a version holds, to tell damage that leaves every size as it was."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexitab.functions.text import csv_line
from lexitab.operators.index import PART_ROWS, with_parts

# A reader drops a byte-order mark at the start of a file, so none is looked at; sizes show a lost one.
_MARK = "^\ufeff+"


def _piece(line: Column) -> Column:
    # Most lines have no mark: these are not made into another string first.
    seen = F.when(line.startswith("\ufeff"), F.regexp_replace(line, _MARK, "")).otherwise(line)
    return F.struct((F.octet_length(seen) + 1).cast("long").alias("size"), F.xxhash64(seen).alias("hash"))


def _digests(pieces: DataFrame, *order: str) -> DataFrame:
    """``(part_file, lines, bytes, digest)`` of slim rows ``(part_file, size, hash)``, one for each line.

    A line counts with its place in the part, so lines that changed places are told as well.  Parts are
    bounded, and so are their windows.
    """
    before = Window.partitionBy("part_file").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0)))
    return placed.groupBy("part_file").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("size").alias("bytes"), F.bit_xor(F.xxhash64("at", "hash")).alias("digest"))


def due_parts(data: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Digests of the CSV parts that ``sinks.files.write_csv_parts`` makes of a data table.

    Only sizes and hashes of lines are moved; a value with line ends has several.
    """
    line = F.col("line")
    lines = F.when(line.contains("\n"), F.split(line, "\n", -1)).otherwise(F.array(line))
    slim = data.select("pid", "row", "byte_length", F.concat(csv_line(), F.lit("\r")).alias("line")).select(
        "pid", "row", "byte_length", F.transform(lines, _piece).alias("pieces"))
    pieces = with_parts(slim, part_rows).select("part_file", "row", F.posexplode("pieces").alias("n", "piece"))
    return _digests(pieces.select("part_file", "row", "n", "piece.*"), "row", "n")


def found_parts(lines: DataFrame) -> DataFrame:
    """Digests of CSV parts as they are, from ``sources.files.read_part_lines``; large ones in splits."""
    slim = lines.select("part_file", "file_path", "block_start", "line_id", _piece(F.col("value")).alias("piece"))
    return _digests(slim.select("*", "piece.*").drop("piece"), "file_path", "block_start", "line_id")


def entries_digest(entries: DataFrame, name: str) -> DataFrame:
    """One digest of all index entries, in any order, as the part ``name``; ``bytes`` are those they point at."""
    each = F.xxhash64("title", F.col("byte_offset").cast("long"), F.col("byte_length").cast("long"))
    return entries.agg(
        F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum(F.col("byte_length").cast("long")), F.lit(0)).alias("bytes"),
        F.coalesce(F.bit_xor(each), F.lit(0)).cast("long").alias("digest")).select(F.lit(name).alias("part_file"), "lines", "bytes", "digest")


def compare(due: DataFrame, found: DataFrame) -> DataFrame:
    """``(part_file, lines, bytes, damaged)`` for every part that should be or is there."""
    what = [F.struct(*(F.col(f"{side}.{name}") for name in ("lines", "bytes", "digest"))) for side in ("d", "f")]
    joined = due.alias("d").join(found.alias("f"), F.col("d.part_file") == F.col("f.part_file"), "full")
    return joined.select(
        F.coalesce("d.part_file", "f.part_file").alias("part_file"), F.coalesce("d.lines", F.lit(0)).alias("lines"),
        F.coalesce("d.bytes", F.lit(0)).alias("bytes"), (~what[0].eqNullSafe(what[1])).alias("damaged"))
