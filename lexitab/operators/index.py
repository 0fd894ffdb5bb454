"""The key -> (byte offset, byte length) index.

``dictionary`` below is a written, sorted table made by ``data_table``: one row per dictionary
row, with its place ``(pid, row)`` in the order.  CSV parts are cut from it by size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexitab.functions.text import csv_title, row_bytes, without_line_end
from lexitab.operators.ordering import bases, number_rows, with_positions
from lexitab.schema import HEADER_BYTES
from lexitab.sources.listing import listed_files

# Bounds of one CSV part: rows, and bytes up to the end of its last row.
PART_ROWS, PART_BYTES = 16_384, 128 * 1024 ** 2


def part_name(pid: Column | str, number: Column | str) -> Column:
    """Folder name of part ``number`` of a partition; names sort as the parts do."""
    return F.format_string("p%010d-%010d", pid, number)


def data_table(ordered_rows: DataFrame, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Add byte lengths and places to range-sorted rows and pass them to ``write``."""
    return write(number_rows(ordered_rows.withColumn("byte_length", row_bytes())))


def with_parts(rows: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Add ``part_file`` and, counted in the partition, the bytes before each row as ``pid_offset``.

    A row weighs what it takes of either bound, and a part ends where the weights fill one part, so
    it holds at most ``part_rows`` rows and PART_BYTES and one more row.  Running sums stay in a
    range partition, whose size is bounded.
    """
    before = Window.partitionBy("pid").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    bound = float(part_rows) * PART_BYTES
    weight = F.greatest(F.col("byte_length").cast("double") * part_rows, F.lit(float(PART_BYTES)))
    number = F.floor(F.coalesce(F.sum(weight).over(before), F.lit(0.0)) / bound)
    offset = F.coalesce(F.sum("byte_length").over(before), F.lit(0)).cast("long")
    return rows.withColumns({"pid_offset": offset, "part_file": part_name("pid", number)})


def build_index(dictionary: DataFrame, *extra: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Offsets of every row: ``byte_offset`` in the logical single file (header first) and
    ``part_offset`` in its part.

    A two-level prefix sum: rows in a partition, then partitions.  Only the latter is a one-task
    window, with one row per range partition, as is the broadcast.  Values are not read; ``extra``
    columns are joined to the finished offsets by their place.
    """
    slim = with_parts(dictionary.select("title", "pid", "row", "byte_length"), part_rows)
    in_part = Window.partitionBy("pid", "part_file")
    slim = slim.withColumn("part_offset", F.col("pid_offset") - F.min("pid_offset").over(in_part))
    starts = bases(slim.groupBy("pid").agg(F.sum("byte_length").alias("bytes")), ["pid"], "bytes")
    placed = slim.join(F.broadcast(starts), "pid").withColumn(
        "byte_offset", F.col("base") + F.col("pid_offset") + HEADER_BYTES)
    if extra:
        placed = placed.join(dictionary.select("pid", "row", *extra), ["pid", "row"])
    return placed.select("title", "byte_offset", "byte_length", "part_file", "part_offset", *extra)


def last_wins(index: DataFrame) -> DataFrame:
    """One entry per exact title, the later row replacing the earlier.

    All buffers are fixed-width numbers, so this is a hash aggregate that combines copies
    before the shuffle.
    """
    kept = [c for c in ("byte_length", "part_file", "part_offset") if c in index.columns]
    return index.groupBy("title").agg(
        F.max("byte_offset").alias("byte_offset"),
        *(F.max_by(c, "byte_offset").alias(c) for c in kept))


def index_validation(rows: DataFrame) -> DataFrame:
    """Index entries against rows; the difference is the number of overwritten entries."""
    counted = rows.groupBy("title").agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.count(F.lit(1)).alias("index_entries"),
                       F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows")) \
        .withColumn("difference", F.col("total_rows") - F.col("index_entries"))


def index_shards(dictionary: DataFrame, shards: int) -> DataFrame:
    """Contiguous shards of equal row counts, by exact position in the order."""
    total = dictionary.count()
    shard = F.floor(F.col("pos") * shards / F.lit(total)).cast("int")
    return with_positions(dictionary.select("pid", "row", "k")).groupBy(shard.alias("shard")).agg(
        F.count(F.lit(1)).alias("entries"), F.min("k").alias("min_key"), F.max("k").alias("max_key"))


# --- index of files that already exist -------------------------------------------------------

def index_lines(lines: DataFrame, header: bool = True) -> DataFrame:
    """Index physical lines read by ``sources.files.read_lines``.

    Returns ``(file_path, title, byte_offset, byte_length)`` with offsets in the file, every
    parseable line once; lines that are blank, not UTF-8 or not CSV still take up their bytes.
    Large files are read in splits: lines are summed inside a split, splits inside their file.
    """
    lines = lines.withColumn("_len", (F.octet_length("value") + 1).cast("long"))
    split = ["file_path", "block_start"]
    sizes = lines.groupBy(*split).agg(F.sum("_len").alias("bytes"), F.max("file_size").alias("file_size"))
    per_file = Window.partitionBy("file_path")
    # Reading drops a byte-order mark and invents a final line end; both show as a difference
    # to the file's size.
    extra = F.max("file_size").over(per_file) - F.sum("bytes").over(per_file)
    before = F.sum("bytes").over(per_file.orderBy("block_start")
                                 .rowsBetween(Window.unboundedPreceding, -1))
    is_last = F.row_number().over(per_file.orderBy(F.desc("block_start"))) == 1
    sizes = sizes.select(*split, "file_size", F.coalesce(before, F.lit(0)).alias("_base"),
                         extra.alias("_extra"), is_last.alias("_last_split"))
    # A lost final line end is -1 and the mark is 3 bytes, so their sum is -1, 0, 2 or 3.
    mark = F.when(F.col("_extra") >= 2, 3).otherwise(0)

    slim = _titles(lines)
    in_split = Window.partitionBy(*split).orderBy("line_id")
    running = F.coalesce(F.sum("_len").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = (slim.withColumn("_local", running).withColumn("_n", F.row_number().over(in_split))
              .join(sizes.drop("file_size"), split))
    first = (F.col("_base") == 0) & (F.col("_n") == 1)
    offset = F.when(first, 0).otherwise(F.col("_base") + F.col("_local") + mark)
    end = F.least(F.col("_base") + F.col("_local") + mark + F.col("_len"), F.col("file_size"))
    placed = placed.withColumn("byte_offset", offset.cast("long")) \
        .withColumn("byte_length", (end - F.col("byte_offset")).cast("int"))
    keep = F.col("title").isNotNull()
    if header:
        keep = keep & ~first
    return placed.filter(keep).select("file_path", "title", "byte_offset", "byte_length")


def line_counts(lines: DataFrame) -> DataFrame:
    """How many physical lines give an entry and how many are skipped; no rows are moved."""
    indexed = F.count_if(_gives_entry())
    return lines.agg(
        F.count(F.lit(1)).alias("total_lines"), indexed.alias("indexed_lines"),
        (F.count(F.lit(1)) - indexed).alias("skipped_lines"),
        F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0)).cast("long").alias("total_bytes"))


def logical_offsets(index: DataFrame, path: str) -> DataFrame:
    """Move offsets in the headerless part files below ``path`` to the single file: header, then parts
    by name.  File sizes come from the listing; one row per file goes through the one-task window."""
    files = listed_files(index.sparkSession, path, "*.txt")
    return index.join(bases(files, ["file_path"], "file_size"), "file_path").select(
        "title", (F.col("byte_offset") + F.col("base") + HEADER_BYTES).alias("byte_offset"), "byte_length")


def _gives_entry() -> Column:
    """Lines that are UTF-8, not blank and free of a carriage return outside quotes."""
    body = without_line_end("value")
    stray_return = body.contains("\r") & F.regexp_replace(body, r'"[^"]*("|$)', "").contains("\r")
    return F.is_valid_utf8("value") & (body != "") & ~stray_return


def _titles(lines: DataFrame) -> DataFrame:
    """Lines reduced to their title; ``NULL`` marks a line that gives no entry."""
    return lines.select("file_path", "block_start", "line_id", "file_size", "_len",
                        F.when(_gives_entry(), csv_title("value")).alias("title"))
