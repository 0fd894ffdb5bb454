"""Sorted files and the ranges of keys that they hold.

A snapshot lists the files of a sorted table, one row each, in the order of their keys:
``(seq, file, first, last, rows, bytes)``.  Keys never descend from one file to the next; a key with very
many rows may fill several files.  What is done here has the size of the list or of the keys given.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexitab.operators.ordering import bases
from lexitab.schema import HEADER_BYTES


def route(keys: DataFrame, bounds: list[tuple[str, str]]) -> DataFrame:
    """``(k, lo, hi)`` for distinct ``k``: the numbers of the first and last file that a key's rows are in.

    Found by binary search.  A key that no file holds belongs to the file before its place, or to the first.
    """
    firsts, lasts = [b[0] for b in bounds], [b[1] for b in bounds]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = [], []
            for key in batch.column("k").to_pylist():
                lo, hi = bisect_left(lasts, key), bisect_right(firsts, key) - 1
                low.append(lo if lo <= hi else max(hi, 0))
                high.append(max(hi, 0))
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(low, pa.int32()), pa.array(high, pa.int32())], ["k", "lo", "hi"])

    return keys.select("k").distinct().mapInArrow(work, "k string, lo int, hi int")


def touched(routed: DataFrame) -> list[int]:
    """Numbers of the files that keys are routed to, ascending; no more than there are files."""
    seqs = routed.select("lo", "hi").distinct().select(F.explode(F.sequence("lo", "hi")).alias("seq")).distinct()
    return sorted(r.seq for r in seqs.collect())


def regions(seqs: list[int]) -> dict[int, int]:
    """The region of each touched file: the first number of its run of touched neighbours."""
    out: dict[int, int] = {}
    for seq in seqs:
        out[seq] = out.get(seq - 1, seq)
    return out


def file_bases(snapshot: DataFrame) -> DataFrame:
    """``(file, base)``: where each file begins in the logical single file, header first.

    The upper level of the offsets: one prefix sum over files, however many rows moved.
    """
    before = bases(snapshot, ["seq"], "bytes")
    return snapshot.join(before, "seq").select("file", (F.col("base") + HEADER_BYTES).alias("base"))


def two_level_index(entries: DataFrame, snapshot: DataFrame) -> DataFrame:
    """``(title, byte_offset, byte_length)`` from entries that are relative to their files.

    Entries of files that the snapshot no longer lists fall out.
    """
    placed = entries.join(file_bases(snapshot), "file")
    return placed.select("title", (F.col("base") + F.col("file_offset")).alias("byte_offset"), "byte_length")
