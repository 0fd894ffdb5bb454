"""Writers: exact-bytes CSV parts, index tables and the manifest pointer."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexitab.functions.text import csv_line, json_text
from lexitab.operators.index import PART_ROWS, part_name, with_parts
from lexitab.operators.ordering import number_rows, range_sort, with_positions
from lexitab.schema import HEADER, JSON_BEGIN, JSON_END, JSON_ENTRY, JSON_INDENT, JSON_LINE, MANIFEST
from lexitab.session import materialise, write_table
from lexitab.sources.listing import listed_bytes

JSON_PART_ENTRIES = 1_000_000


def write_csv_parts(dictionary: DataFrame, path: str, part_rows: int = PART_ROWS) -> None:
    """Write a sorted data table as CSV parts, one file below each ``part_file=...`` folder.

    Header plus parts in name order is, byte for byte, the single CSV file.  Parts carry no
    header, so their offsets start at zero.  ``DataFrameWriter.csv`` is not used: it trims
    blanks and writes empty strings differently.
    """
    lines = dictionary.select("pid", "row", "byte_length", csv_line().alias("line"))
    _write_parts(with_parts(lines, part_rows), path, "\r\n")


def _write_parts(lines: DataFrame, path: str, line_end: str) -> None:
    """One text file per part: all lines of a part meet in one task, in order.

    Lines of parts that ``with_parts`` made are together already, by their partition.
    """
    (lines.sortWithinPartitions("part_file", "row").select("line", "part_file")
     .write.mode("errorifexists").partitionBy("part_file").option("lineSep", line_end).text(path))


def write_csv_header(spark: SparkSession, path: str) -> None:
    _put(spark, path, HEADER + "\r\n")


def write_index(index: DataFrame, path: str) -> DataFrame:
    """The index as a zstd Parquet table, each file one shard with its own range of titles, so
    that a lookup of few keys skips the other files; returns the written table."""
    return write_table(range_sort(index, ["title"]), path)


def write_index_json(index: DataFrame, path: str) -> None:
    """The index as one JSON object ``{title: {"offset", "length"}}``, cut into parts.

    Parts in name order are the object, with entries by offset; each entry is written by itself,
    so no task holds the object.
    """
    ordered = range_sort(index.select("title", "byte_offset", "byte_length"), ["byte_offset"])
    placed = with_positions(materialise(number_rows(ordered), "json"))
    last = index.count() - 1
    entry = F.concat(
        F.when(F.col("pos") == 0, JSON_BEGIN).otherwise(""), F.lit(JSON_INDENT), json_text("title"),
        F.format_string(JSON_ENTRY, "byte_offset", "byte_length"),
        F.when(F.col("pos") == last, JSON_END).otherwise(","))
    part = part_name(F.lit(0), F.floor(F.col("pos") / JSON_PART_ENTRIES))
    lines = placed.select(part.alias("part_file"), F.col("pos").alias("row"), entry.alias("line"))
    _write_parts(lines.repartition("part_file"), path, JSON_LINE)


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, target, fs = _file_system(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none if it does not exist."""
    _, target, fs = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) else []


# Stores whose rename replaces a file in one step.  Any other store shows a new object when its one put
# has ended, and has no such rename.
RENAMING = {"file", "hdfs", "viewfs"}


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write one small object so that readers see the old or the new text, never a part of it or none."""
    jvm, target, fs = _file_system(spark, path)
    renames = (fs.getUri().getScheme() or "file") in RENAMING
    written = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp") if renames else target
    stream = fs.create(written, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not renames:
        return
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(written, target, options)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small object unless there is one; whether this call created it.

    File systems that refuse to overwrite decide in one step who comes first.
    """
    jvm, target, fs = _file_system(spark, path)
    try:
        stream = fs.create(target, False)
    except Py4JJavaError as error:
        if fs.exists(target):
            return False
        raise error
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    return True


def write_manifest(spark: SparkSession, path: str, manifest: dict[str, str]) -> None:
    """Switch the manifest: the last step of every build."""
    unknown = set(manifest) - set(MANIFEST.names)
    if unknown:
        raise ValueError(f"unknown manifest fields: {sorted(unknown)}")
    _put(spark, path, json.dumps(manifest, indent=2, ensure_ascii=False))
    if not exists(spark, path):
        raise IOError(f"manifest not found after writing: {path}")
