"""CSV of any quoting, read in splits with the records that Python's reader would give.

Where a record ends depends on all quotes before it, so a split cannot know by itself whether it begins
inside of quotes.  Each split is run from both states a line can begin in; the states at the splits'
borders follow by composing what each split does to them; then each split cuts its own records.  Only
records that lie across a border are put together from pieces.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lexitab.schema import DICT
from lexitab.session import materialise
from lexitab.sources.files import read_lines

FILE, SPLIT = "file_path", "block_start"
# A header longer than this is taken for a quote that was never closed.
HEADER_CHARS = 65_536


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the reader is inside of quotes after a line that it began inside or outside of them.

    Only a quote at the start of a field opens it.  Two quotes inside are one character; after the closing
    one the rest of the field is plain text.
    """
    if '"' not in line:
        return inside
    at = 0
    while True:
        if not inside and line.startswith('"', at):
            inside, at = True, at + 1
        if inside:
            quote = line.find('"', at)
            while quote >= 0 and line.startswith('"', quote + 1):
                quote = line.find('"', quote + 2)
            if quote < 0:
                return True
            inside, at = False, quote + 1
        at = line.find(",", at) + 1
        if not at:
            return False


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, list]]:
    """``(file, split, whether it goes on, rows)``; a task's rows come split by split, in the order of their lines."""
    last = None
    for batch in batches:
        rows = batch.to_pylist()
        start = 0
        while start < len(rows):
            key = (rows[start][FILE], rows[start][SPLIT])
            end = start + 1
            while end < len(rows) and (rows[end][FILE], rows[end][SPLIT]) == key:
                end += 1
            yield *key, key == last, rows[start:end]
            last, start = key, end


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split does, entered outside (0) and inside (1) of quotes: where it ends, and how many records begin."""
    made: list[dict] = []
    for file, split, goes_on, rows in _by_split(batches):
        if not goes_on:
            made.append({FILE: file, SPLIT: split, "exit0": False, "exit1": True, "n0": 0, "n1": 0})
        now = made[-1]
        for row in rows:
            for way in "01":
                now[f"n{way}"] += not now[f"exit{way}"]
                now[f"exit{way}"] = ends_inside(row["value"], now[f"exit{way}"])
    schema = pa.schema([(FILE, pa.string()), (SPLIT, pa.int64()), ("exit0", pa.bool_()), ("exit1", pa.bool_()), ("n0", pa.int64()), ("n1", pa.int64())])
    yield pa.RecordBatch.from_pylist(made, schema)


def _entries(splits: DataFrame) -> DataFrame:
    """``(file, split, inside, base)``: the state each split is entered in and the records begun before it.

    A split leaves the state alone, turns it over, or fixes it.  So the state is what the last fixing split
    before gave, turned over once for each turning split since: running sums over the splits of a file.
    """
    in_file = Window.partitionBy(FILE).orderBy(SPLIT)
    upto, before = in_file.rowsBetween(Window.unboundedPreceding, 0), in_file.rowsBetween(Window.unboundedPreceding, -1)
    fixes = F.col("exit0") == F.col("exit1")
    turned = F.sum((~fixes & F.col("exit0")).cast("int"))
    splits = splits.withColumn("_turned", turned.over(upto))
    fixed = F.last(F.when(fixes, F.struct(F.col("exit0").cast("int").alias("state"), F.col("_turned").alias("at"))), ignorenulls=True).over(before)
    since = F.coalesce(turned.over(before), F.lit(0)) - F.coalesce(fixed["at"], F.lit(0))
    splits = splits.withColumn("inside", (F.coalesce(fixed["state"], F.lit(0)) + since) % 2 == 1)
    begun = F.when(F.col("inside"), F.col("n1")).otherwise(F.col("n0"))
    return splits.select(FILE, SPLIT, "inside", F.coalesce(F.sum(begun).over(before), F.lit(0)).alias("base"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each split; ``whole`` is false for a piece of one that lies across a border."""
    schema = pa.schema([(FILE, pa.string()), (SPLIT, pa.int64()), ("record", pa.int64()), ("whole", pa.bool_()), ("body", pa.string())])
    open_at: tuple | None = None
    lines: list[str] = []
    inside = begun = False
    number = 0

    def piece(ends: bool) -> dict:
        return {FILE: open_at[0], SPLIT: open_at[1], "record": number, "whole": begun and ends, "body": "\n".join(lines)}

    for file, split, goes_on, rows in _by_split(batches):
        made = []
        if not goes_on:
            if lines:
                made.append(piece(not inside))
            open_at, lines, begun = (file, split), [], False
            inside, number = rows[0]["inside"], rows[0]["base"] - 1
        for row in rows:
            if not inside:
                if lines:
                    made.append(piece(True))
                lines, begun, number = [], True, number + 1
            lines.append(row["value"])
            inside = ends_inside(row["value"], inside)
        yield pa.RecordBatch.from_pylist(made, schema)
    if lines:
        yield pa.RecordBatch.from_pylist([piece(not inside)], schema)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file_path, record, body)``: the records of CSV files, numbered from 0 in each file.

    Files are read twice, by as many tasks as they have splits: first for what each split does to the
    state, then to cut records.  No text is in an exchange but that of records across two splits.
    """
    lines = read_lines(spark, path).select(FILE, SPLIT, F.col("value"))
    splits = materialise(lines.mapInArrow(
        _run, f"{FILE} string, {SPLIT} bigint, exit0 boolean, exit1 boolean, n0 bigint, n1 bigint"), "splits")
    # One row per split, as the scan itself lists them.
    known = lines.join(F.broadcast(_entries(splits)), [FILE, SPLIT], "left")
    unknown = F.raise_error(F.lit("the files were cut into other splits when they were read again"))
    known = known.withColumn("inside", F.coalesce("inside", unknown.cast("boolean")))
    pieces = known.mapInArrow(_cut, f"{FILE} string, {SPLIT} bigint, record bigint, whole boolean, body string")
    pieces = materialise(pieces, "records")
    joined = pieces.filter("not whole").groupBy(FILE, "record").agg(F.expr(f"listagg(body, '\n') WITHIN GROUP (ORDER BY {SPLIT})").alias("body"))
    return pieces.filter("whole").select(FILE, "record", "body").unionByName(joined)


def _fields(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two fields of each record by their places; a missing field is empty."""
    csv.field_size_limit(sys.maxsize)
    for batch in batches:
        places = list(zip(batch.column("_title").to_pylist(), batch.column("_value").to_pylist()))
        found: list[list[str]] = [[], []]
        for body, wanted in zip(batch.column("body").to_pylist(), places):
            fields = next(csv.reader(_physical(body)), [])
            for out, at in zip(found, wanted):
                out.append(fields[at] if 0 <= at < len(fields) else "")
        yield pa.RecordBatch.from_arrays([batch.column(FILE), batch.column("record"), *(pa.array(f, pa.string()) for f in found)],
                                         [FILE, "record", *DICT.names])


def _physical(body: str) -> list[str]:
    """Lines at line feeds only, each with its end."""
    lines = body.split("\n")
    return [*(line + "\n" for line in lines[:-1]), lines[-1]]


def _places(headers: list[str]) -> tuple[Column, Column]:
    """The places of title and value in the header of a row's own file; -1 for a missing value."""
    places = []
    for name in DICT.names:
        place = F.lit(-1)
        for header in headers:
            names = next(csv.reader(_physical(header)), [])
            if DICT.names[0] not in names:
                raise ValueError(f"a CSV header without '{DICT.names[0]}': {header[:200]!r}")
            if name in names:
                place = F.when(F.col("_header") == header, names.index(name)).otherwise(place)
        places.append(place)
    return tuple(places)


def read_split_dictionary(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """A dictionary CSV as ``(title, value, ord)``, like ``read_dictionary``, with large files read in splits.

    Records and fields are those of Python's reader, also where quotes stand inside unquoted fields or text
    follows a closing quote.  Each file's columns go by its own header; ``header=False`` reads files that
    begin with a row.  Blank lines give no row; a line end inside quotes becomes ``\\n``.  A quote that is
    never closed makes the rest of its file, but for its last line end, one field.
    """
    records = materialise(read_records(spark, path), "records")
    if header:
        clean = F.rtrim(F.regexp_replace("body", "^﻿", ""), F.lit("\r"))
        heads = records.filter("record = 0").select(FILE, F.when(
            F.length("body") > HEADER_CHARS, F.raise_error(F.lit("a header without an end: is a quote never closed?")).cast("string")).otherwise(clean).alias("_header"))
        heads = materialise(heads, "headers")
        title, value = _places([r[0] for r in heads.select("_header").distinct().collect()])
        rows = records.filter("record > 0").join(heads, FILE)
    else:
        rows, (title, value) = records, (F.lit(0), F.lit(1))
    rows = rows.withColumn("body", F.rtrim("body", F.lit("\r"))).filter("body <> ''")
    parsed = rows.select(FILE, "record", "body", title.alias("_title"), value.alias("_value")).mapInArrow(
        _fields, f"{FILE} string, record bigint, title string, value string")
    return parsed.select(
        *(F.regexp_replace(n, "\r\n?", "\n").alias(n) for n in DICT.names),
        F.struct(F.col(FILE).alias("file"), F.lit(0).cast("long").alias("block"), F.col("record").alias("row")).alias("ord"))
