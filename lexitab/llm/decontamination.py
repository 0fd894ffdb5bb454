"""Benchmark decontamination by size-partitioned MinHash containment search (DataFrame functions only).

An item with ``n`` word shingles is contained in a document to the degree ``t`` if the document has at
least ``ceil(t n)`` of them.  Documents are far longer than items, so their similarity says nothing;
containment is searched with bottom sketches: the ``b`` smallest hashes of the item's shingles.  With
``b = n - ceil(t n) + 1`` a document that reaches ``t`` has at least one hash of the sketch, as it
lacks at most ``b - 1`` shingles: no link is lost.  Items are partitioned by size into powers of two,
and a partition's largest size gives ``b`` for all its items.  Hashes are weighted by how many items hold
the shingle, so what many items share, such as a template, is seldom in a sketch.  Found pairs, and only
these, are verified on the shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from lexitab.llm.columns import unused
from lexitab.plans.fixtures import table
from lexitab.session import materialise

WORDS, THRESHOLD = 5, 0.8
# A sketch of more hashes than this (16 bytes each) is joined by an exchange in place of a broadcast.
BROADCAST_HASHES = 1_000_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; no word for a null or empty text."""
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(clean, " "), lambda w: w != "")


def _per_shingle(text: Column, made, sizes: list[int]) -> Column:
    """An array with ``made(words of the shingle)`` for every shingle of the given sizes, repeats included.

    The words go in as a lambda variable: they are made once, not once for every shingle.
    """
    def of_size(w: Column, size: int) -> Column:
        starts = F.when(F.size(w) >= size, F.sequence(F.lit(0), F.size(w) - size))
        return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: made([w[i + j] for j in range(size)]))
    return F.transform(F.array(words(text)), lambda w: F.concat(*(of_size(w, size) for size in sizes)))[0]


def shingles(text: Column, sizes: list[int]) -> Column:
    return _per_shingle(text, lambda w: F.concat_ws(" ", *w), sizes)


def shingle_hashes(text: Column, sizes: list[int]) -> Column:
    return _per_shingle(text, lambda w: F.xxhash64(F.concat_ws(" ", *w)), sizes)


def item_shingles(items: DataFrame) -> DataFrame:
    """Distinct ``(item, item_id, size, shingle, h, rank, n)`` of items that have a word.

    Every distinct ``(item_id, text)`` is an ``item`` of its own, also where ids are null or repeated.  Its
    shingles have five words; a shorter item is one shingle of all its words.  ``n`` is their number and
    ``rank`` the place in the order of a second hash, weighted by the square of the items that hold the
    shingle: one that ``k`` items hold is in a sketch with a chance of about ``1 / k^2``, so that the
    pairs it makes do not grow with ``k``.
    """
    own = items.select("item_id", "text").distinct().withColumn("item", F.monotonically_increasing_id())
    kept = materialise(own.select("item", "item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0), "benchmark")
    size = F.least(F.size("w"), F.lit(WORDS))
    at = F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda i: F.concat_ws(" ", F.slice("w", i, size)))
    each = kept.select("item", "item_id", size.alias("size"), F.explode(F.array_distinct(at)).alias("shingle"))
    held = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("held"))
    u = (F.pmod(F.xxhash64(F.lit("rank"), "shingle"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    per_item = Window.partitionBy("item")
    rank = F.row_number().over(per_item.orderBy(-F.ln(u) * F.pow("held", F.lit(2)), "shingle"))
    return each.join(held, "shingle").select("item", "item_id", "size", "shingle", F.xxhash64("shingle").alias("h"),
                                             rank.alias("rank"), F.count(F.lit(1)).over(per_item).alias("n"))


def needed(n: Column, threshold: float) -> Column:
    """Shingles that have to be found; the tolerance is for products such as 0.8 * 35."""
    return F.ceil(n * F.lit(threshold) - 1e-9)


def sketches(parts: DataFrame, threshold: float) -> DataFrame:
    """The sketch ``(h, item)`` of every item, as long as its size partition asks for."""
    largest = (F.pow(F.lit(2.0), F.floor(F.log2("n")) + 1) - 1).cast("long")
    longest = largest - needed(largest, threshold) + 1
    return parts.filter(F.col("rank") <= longest).select("h", "item")


def candidates(docs: DataFrame, parts: DataFrame, sizes: list[int], threshold: float) -> DataFrame:
    """The ``(doc_id, item)`` that share a hash of the item's sketch."""
    sketch = materialise(sketches(parts, threshold), "sketches")
    small = sketch.count() <= BROADCAST_HASHES
    hashes = docs.select("doc_id", F.explode(shingle_hashes(F.col("text"), sizes)).alias("h"))
    found = hashes.join(F.broadcast(sketch) if small else sketch, "h")
    return materialise(found.select("doc_id", "item").distinct(), "candidates")


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, item_id, n_shingles, n_found, containment)`` of every pair that reaches ``threshold``.

    Whole texts are searched; rows that share a doc_id, null among them, count as one document, while
    every distinct row of the items is an item.  Items and texts without a word contain nothing and are
    contained in nothing; an item of fewer than five words is found where all of it stands.  Documents are
    read twice: once for the hashes, once for the candidates' shingles, which meet the shingles of their
    own items only.
    """
    parts = materialise(item_shingles(items), "items")
    # Five sizes at most, and only those that some item has.
    sizes = sorted(r[0] for r in parts.select("size").distinct().collect())
    if not sizes:
        return docs.select("doc_id").join(items.select("item_id").limit(0)).limit(0).select(
            "doc_id", "item_id", *(F.lit(None).cast(k).alias(n) for n, k in (("n_shingles", "long"), ("n_found", "long"), ("containment", "double"))))
    pairs = candidates(docs, parts, sizes, threshold).withColumnRenamed("doc_id", "_doc")

    texts = docs.select("doc_id", "text").join(
        pairs.select("_doc").distinct(), F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    seen = texts.select("doc_id", F.explode(F.array_distinct(shingles(F.col("text"), sizes))).alias("shingle")).join(
        parts.select("shingle").distinct(), "shingle", "left_semi").distinct()
    # A row for each shingle of each candidate; hot documents or items only make more rows, each with its own key.
    wanted = pairs.join(parts.select("item", "item_id", F.col("shingle").alias("_shingle"), "n"), "item")
    matched = seen.join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("shingle") == F.col("_shingle")))
    hits = matched.groupBy("doc_id", "item", "item_id").agg(F.max("n").alias("n_shingles"), F.count(F.lit(1)).alias("n_found"))
    return (hits.filter(F.col("n_found") >= needed(F.col("n_shingles"), threshold)).drop("item")
            .withColumn("containment", F.col("n_found") / F.col("n_shingles")))


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns; rows that share a doc_id are one document."""
    name = unused(docs, "_doc")
    bad = contained(docs, items, threshold).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")


def decontaminate_rows(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose own text contains no item, with all their columns.

    Rows that share a doc_id, null among them, are told apart by their texts: a row goes only for what
    it contains itself.
    """
    name = unused(docs, "_doc")
    row = F.concat_ws(":", F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")), F.col("doc_id").cast("string"))
    named = docs.withColumn(name, row)
    bad = contained(named.select(F.col(name).alias("doc_id"), "text"), items, threshold)
    return named.join(bad.select(F.col("doc_id").alias(name)).distinct(), name, "left_anti").select(
        *(F.col(f"`{c}`") for c in docs.columns))


def op9_decontamination(spark, sf_dir):
    """All documents against all benchmark items."""
    return contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP9_SQL = r"""
WITH i AS (
    SELECT row_number() OVER () AS item, item_id, w, least(len(w), 5) AS size FROM (
        SELECT DISTINCT item_id, text, list_filter(string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' '),
            lambda x: x <> '') AS w FROM benchmark)
    WHERE len(w) > 0),
d AS (
    SELECT doc_id, list_filter(string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' '),
        lambda x: x <> '') AS w FROM documents),
items AS (
    SELECT item, item_id, shingle, count(*) OVER (PARTITION BY item) AS n FROM (
        SELECT DISTINCT item, item_id, unnest(list_transform(range(1, len(w) - size + 2), lambda k: array_to_string(w[k:k + size - 1], ' '))) AS shingle
        FROM i)),
s AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - size + 2), lambda k: array_to_string(w[k:k + size - 1], ' '))) AS shingle
    FROM d, (SELECT DISTINCT size FROM i) WHERE len(w) >= size)
SELECT doc_id, item_id, max(n) AS n_shingles, count(*) AS n_found, count(*) / max(n) AS containment
FROM s JOIN items USING (shingle)
GROUP BY doc_id, item, item_id HAVING count(*) >= ceil(max(n) * 0.8 - 1e-9)
"""
