"""Bounded samples of labelled rows to fit a classifier on."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexitab.session import materialise

BITS = 53
# Different labels that a classifier is fitted for.
MAX_LABELS = 1_000


def fold_of(doc_id: str, folds: int) -> Column:
    """The fold of a document: the CRC-32 of its id's text modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def label_counts(rows: DataFrame, label: str) -> dict:
    """Rows of each label, of which a classifier can have MAX_LABELS; more are an error, as in a dirty column."""
    found = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(MAX_LABELS + 1).collect()
    if len(found) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} different values of {label}")
    return {r[0]: r.n for r in found}


def _thinned(rows: DataFrame, label: str, counts: dict, size: int, key: Column) -> DataFrame:
    """Rows whose hash is in the lowest part that holds ``size`` rows of its label, with room for chance.

    So what is ranked afterwards is about ``size`` rows of a label, however many there are.
    """
    wanted = size + 6 * math.sqrt(size) + 10
    few = {value: wanted / n for value, n in counts.items() if n > wanted}
    if not few:
        return rows
    share = F.create_map(*(F.lit(x) for pair in few.items() for x in pair))[F.col(label)]
    return rows.filter(F.shiftrightunsigned(key, 64 - BITS) < F.coalesce(share, F.lit(1.0)) * float(1 << BITS))


def _first(rows: DataFrame, label: str, size: int, *order: Column | str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(label).orderBy(*order))
    return rows.withColumn("_n", rank).filter(F.col("_n") <= size).drop("_n")


def bounded_sample(docs: DataFrame, marks: DataFrame, label: str, size: int) -> tuple[DataFrame, dict]:
    """At most ``size`` rows of ``(doc_id, text, label)`` for each label, and the rows of each label.

    ``marks`` holds ``(doc_id, label)``, one or more per document; null labels are left out.  Ids are
    chosen by the order of their hash, with no text read.  The chosen ids are few, ``size`` times the
    labels at most, and are broadcast to the texts.  If one id has very many rows, these are thinned the
    same way; repeats of a row count once.
    """
    ids = marks.filter(F.col(label).isNotNull()).select(F.col("doc_id").alias("_doc"), label).distinct()
    counts = label_counts(ids, label)
    by_id = F.xxhash64("_doc")
    chosen = materialise(_first(_thinned(ids, label, counts, size, by_id), label, size, by_id, "_doc"), "chosen")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id").eqNullSafe(F.col("_doc"))).drop("_doc")
    by_row = F.xxhash64("doc_id", "text")
    kinds = texts.select(label, "doc_id", by_row.alias("_h")).distinct()
    some = _thinned(texts, label, label_counts(kinds, label), size, by_row)
    once = some.withColumn("_h", by_row).dropDuplicates([label, "doc_id", "_h"])
    return _first(once, label, size, "_h", "doc_id").select("doc_id", "text", label), counts
