"""Filter interaction audit: what each filter removes in every order, by a Gray-code walk over subsets.

Documents are reduced to a mask of the filters that they fail, and counted by mask: 2^k cells for k
filters.  A Gray code visits all subsets of filters, toggling one filter at a time: each cell keeps a
counter of its failures among the active filters, and the running survivors change by the cells whose
counter leaves or reaches zero.  The survivors of all 2^k states are stored, and any step of any order is
the difference of two of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lexitab.plans.fixtures import table
from lexitab.session import materialise

NAMES = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3
BLANKS = " \t\n\x0b\x0c\r"
# What is counted in every cell: documents, those of quality 1 and toxic ones.
COUNTED = ("n", "good", "toxic")


def text_failures(text: Column) -> Column:
    """The bits of filters A to D that a text fails: too few words, too few distinct ones, too many
    capitals, marks of code.  No word for an empty text, which fails A only."""
    trimmed = F.btrim(text, F.lit(BLANKS))

    def bits(words: Column) -> Column:
        n, distinct = F.size(words), F.size(F.array_distinct(words))
        capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
        failed = (n < MIN_WORDS, distinct * 100 < n * DISTINCT_PERCENT,
                  capitals.cast("long") * 100 > F.length(text).cast("long") * CAPITAL_PERCENT, text.rlike(r"[#$%&*|]"))
        return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0))

    # As the element of an array the words are made once, not once for every use.
    some = F.transform(F.array(F.split(trimmed, r"[ \t-\r]+")), bits)[0]
    return F.when(trimmed == "", 1).otherwise(some)


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents of each part and mask of failed filters.

    The part is the document's ``lang``, the empty string for null.  Bit 4 (E) is set if a smaller doc_id
    has the same text, by SHA-256, anywhere in the table; a null doc_id has no smaller one and is smaller
    than none.  Null texts count as empty.  Every row is a document; it is good or toxic if any row of
    ``labels`` with its doc_id says so, so one without a label is neither.

    Texts are read once and leave the scan as digests.  Repeated rows are combined before they move, and
    the smallest doc_id of a text is a combined minimum that meets its own rows by text and doc_id: a text
    of very many documents is a hot key nowhere.
    """
    text = F.coalesce("text", F.lit(""))
    slim = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text_failures(text).alias("mask"))
    keys = ["doc_id", "part", "digest", "mask"]
    rows = materialise(slim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "failures")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null").withColumn("first", F.lit(True))
    marks = labels.groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                                         F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    repeated = F.col("doc_id").isNotNull() & F.col("first").isNull()
    masked = (rows.join(firsts, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
              .select("part", (F.col("mask") + F.when(repeated, 16).otherwise(0)).alias("mask"), "n",
                      *((F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in COUNTED[1:])))
    return masked.groupBy("part", "mask").agg(*(F.sum(c).cast("long").alias(c) for c in COUNTED))


def survivors(cells: np.ndarray) -> np.ndarray:
    """Documents that pass all active filters, for every subset of filters as a bit mask.

    ``cells`` has a row per mask of failed filters.  The subsets are walked in Gray-code order.
    """
    states = len(cells)
    masks = np.arange(states)
    failures = np.zeros(states, dtype=np.int64)
    out = np.zeros_like(cells)
    active, running = 0, cells.sum(axis=0)
    out[0] = running
    for step in range(1, states):
        bit = (step & -step).bit_length() - 1
        touched = np.flatnonzero(masks >> bit & 1)
        active ^= 1 << bit
        if active >> bit & 1:
            running = running - cells[touched[failures[touched] == 0]].sum(axis=0)
            failures[touched] += 1
        else:
            failures[touched] -= 1
            running = running + cells[touched[failures[touched] == 0]].sum(axis=0)
        out[active] = running
    return out


def steps(cells: np.ndarray, names: str = NAMES) -> list[dict]:
    """A row for every step of every order of the filters, from the documents of one part."""
    k, alive = len(names), survivors(cells)
    everything = (1 << k) - 1
    shapley = [sum(factorial(bin(s).count("1")) * factorial(k - 1 - bin(s).count("1")) * int(alive[s, 0] - alive[s | 1 << f, 0])
                   for s in range(1 << k) if not s >> f & 1) for f in range(k)]
    rows = []
    for order in permutations(range(k)):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            lost = alive[before] - alive[after]
            rows.append({
                "filter_order": "".join(names[i] for i in order), "step": step, "kept": int(alive[after, 0]),
                "removed": int(lost[0]), "redundant": int(alive[0, 0] - alive[1 << f, 0] - lost[0]),
                "unique_fails": int(alive[everything ^ 1 << f, 0] - alive[everything, 0]),
                "good_lost": int(lost[1]), "toxic_lost": int(lost[2]), "shapley": shapley[f]})
            before = after
    return rows


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            cells = np.zeros((1 << len(NAMES), len(COUNTED)), dtype=np.int64)
            for cell in row["cells"]:
                cells[cell["mask"]] = [cell[c] for c in COUNTED]
            yield pa.RecordBatch.from_pylist([{"part": row["part"], **r} for r in steps(cells)], pa.schema(
                [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
                + [(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``:
    600 rows for every part, all counts inside the part.

    A filter's ``redundant`` documents fail it but were removed before; ``unique_fails`` fail it only;
    ``shapley`` is what it removes, summed over all orders.  No documents give no part and no row.
    Counting is a map-side combined aggregate, of at most 32 rows a part; the walk meets these only.
    """
    cell = F.struct("mask", *COUNTED)
    parts = failure_masks(docs, labels).groupBy("part").agg(F.collect_list(cell).alias("cells"))
    return parts.mapInArrow(_walked, "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
                                     "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def op11_filter_audit(spark, sf_dir):
    """All documents, with the labels that there are."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents),
marks AS (SELECT doc_id, max((coalesce(quality, 0) = 1)::INT) AS good, max((coalesce(toxic, 0) = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failed AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text), regexp_matches(text, '[#$%&*|]'),
         doc_id IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY text)] AS fails
    FROM words LEFT JOIN marks USING (doc_id)),
cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails),
letters AS (SELECT * FROM range(1, 6) r(i)),
orders AS (
    SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
at_step AS (
    SELECT part, list_aggregate(list_transform(o, lambda i: chr((64 + i)::INT)), 'string_agg', '') AS filter_order, s AS step, o[s] AS f, n, good, toxic,
        fails[o[s]] AS fails_it, list_bool_or(list_transform(o[1:s - 1], lambda i: fails[i])) AS gone,
        len(list_filter(fails, lambda x: x)) AS n_fails
    FROM cells, orders, range(1, 6) r(s)),
counted AS (
    SELECT part, filter_order, step, f,
        sum(n) FILTER (NOT fails_it AND NOT coalesce(gone, false)) AS kept, sum(n) FILTER (fails_it AND NOT coalesce(gone, false)) AS removed,
        sum(n) FILTER (fails_it AND gone) AS redundant, sum(n) FILTER (fails_it AND n_fails = 1) AS unique_fails,
        sum(good) FILTER (fails_it AND NOT coalesce(gone, false)) AS good_lost,
        sum(toxic) FILTER (fails_it AND NOT coalesce(gone, false)) AS toxic_lost
    FROM at_step GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
    coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
    coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM counted
"""
