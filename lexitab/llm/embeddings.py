"""Near-duplicate vectors of equal label by int8 tile products with rigorous error bounds.

A unit vector ``u`` is stored as ``s q`` with whole numbers ``q`` of at most 127 and the length ``e`` of
what is lost.  For two of them ``|u.v - s_u s_v q_u.q_v| <= |s_u q_u| e_v + |s_v q_v| e_u + e_u e_v``, so
the product of the small numbers decides most pairs; the rest is computed again in double precision.
Vectors are quantised once, where they are read, and only their small numbers are dealt to tiles.  Full
vectors go to the pairs of tiles in which the bounds leave them open.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from lexitab.llm.components import components, forest
from lexitab.plans.fixtures import table
from lexitab.session import materialise

THRESHOLD = 0.93
# Bounds of a tile: vectors, and components in all of them; and rows of the product held at a time.
TILE, COMPONENTS, ROWS = 4_096, 1 << 20, 256
LEVELS = 127
# Open pairs whose full vectors are multiplied at a time.
PAIRS = 1 << 14
# Room for the rounding of double sums, far below what quantising loses.
SLACK = 1e-9


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(q, s, e)`` of unit rows: int8 numbers, scales, and the exact lengths of the remainders."""
    scale = np.abs(unit).max(axis=1) / LEVELS
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(unit - q * scale[:, None], axis=1) + SLACK


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows of length one; the largest component is taken out first, so that no square overflows."""
    values = values / np.abs(values).max(axis=1)[:, None]
    return values / np.linalg.norm(values, axis=1)[:, None]


def decide(left: tuple, right: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of quantised rows ``(q, s, e)`` surely reach the threshold, and which may.

    Sums of int8 products are whole numbers; float32 holds them exactly up to 1,000 components and
    float64 beyond, and both use the fast matrix product.
    """
    (ql, sl, el), (qr, sr, er) = left, right
    kind = np.float32 if ql.shape[1] * LEVELS ** 2 < 1 << 24 else np.float64
    about = (ql.astype(kind) @ qr.astype(kind).T) * sl[:, None] * sr[None, :]
    bound = (1 + el)[:, None] * er[None, :] + el[:, None] * (1 + er)[None, :] + el[:, None] * er[None, :] + SLACK
    sure = about - bound >= threshold
    return sure, (about + bound >= threshold) & ~sure


def _blocks(rows: pa.Table, dim: int, ti: int, tj: int, threshold: float):
    """``(left positions, right positions, sure, open)`` of a pair of tiles, ROWS rows of the left at a
    time; no row meets itself."""
    q = np.frombuffer(b"".join(rows["q"].to_pylist()), dtype=np.int8).reshape(-1, dim)
    scale, lost = rows["scale"].to_numpy(), rows["lost"].to_numpy()
    tile = rows["tile"].to_numpy()
    left, right = np.flatnonzero(tile == ti), np.flatnonzero(tile == tj)
    others = (q[right], scale[right], lost[right])
    for start in range(0, len(left), ROWS):
        part = left[start:start + ROWS]
        sure, maybe = decide((q[part], scale[part], lost[part]), others, threshold)
        if ti == tj:
            own = np.arange(len(part))
            sure[own, start + own] = maybe[own, start + own] = False
        yield part, right, sure, maybe


class _Links:
    """Links among the rows of a task: for each row the number of vectors linked to it (copies counted),
    and a forest of links, never the pairs themselves."""

    def __init__(self, copies: np.ndarray, both: bool):
        self.copies, self.both = copies, both
        self.count = np.zeros(len(copies), dtype=np.int64)
        self.root = np.arange(len(copies))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(self.count, i, self.copies[j])
        if self.both:
            np.add.at(self.count, j, self.copies[i])
        own = np.arange(len(self.root))
        self.root = forest(np.concatenate([i, own]), np.concatenate([j, self.root]), len(own))


def _by_bounds(threshold: float):
    """What the small numbers say about a pair of tiles, or about one: sure links, and which rows have a
    pair that is left open."""
    def work(key: tuple, rows: pa.Table) -> pa.Table:
        dim, ti, tj = (key[k].as_py() for k in (1, 2, 3))
        found = _Links(rows["copies"].to_numpy(), ti != tj)
        left_open = np.zeros(len(found.root), dtype=bool)
        for part, right, sure, maybe in _blocks(rows, dim, ti, tj, threshold):
            i, j = np.nonzero(sure)
            found.add(part[i], right[j])
            left_open[part] |= maybe.any(axis=1)
            left_open[right] |= maybe.any(axis=0)
        some = np.flatnonzero((found.count > 0) | left_open)
        c = rows["c"].to_numpy()
        return pa.table({"ti": pa.array(np.full(len(some), ti, dtype=np.int32)), "tj": pa.array(np.full(len(some), tj, dtype=np.int32)),
                         "a": c[some], "b": c[found.root[some]], "links": found.count[some], "open": left_open[some]})
    return work


def _in_full(threshold: float):
    """The links among the open pairs of a pair of tiles, by cosines in double precision."""
    def work(key: tuple, rows: pa.Table) -> pa.Table:
        dim, ti, tj = (key[k].as_py() for k in (1, 2, 3))
        found = _Links(rows["copies"].to_numpy(), ti != tj)
        unit = unit_rows(_matrix(rows["embedding"].combine_chunks(), dim))
        for part, right, _, maybe in _blocks(rows, dim, ti, tj, threshold):
            i, j = np.nonzero(maybe)
            i, j = part[i], right[j]
            for start in range(0, len(i), PAIRS):
                a, b = i[start:start + PAIRS], j[start:start + PAIRS]
                near = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
                found.add(a[near], b[near])
        some = np.flatnonzero(found.count)
        c = rows["c"].to_numpy()
        return pa.table({"a": c[some], "b": c[found.root[some]], "links": found.count[some]})
    return work


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("embedding")
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        made: list[list] = [[None] * len(sizes) for _ in range(4)]
        for dim in np.unique(sizes[sizes > 0]).tolist():
            at = np.flatnonzero(sizes == dim)
            values = _matrix(column.take(pa.array(at)), dim) + 0.0  # both zeros are one
            for row, *parts in zip(at.tolist(), values, *quantise(unit_rows(values))):
                for into, part in zip(made, (sha256(parts[0].tobytes()).digest(), parts[1].tobytes(), parts[2], parts[3])):
                    into[row] = part
        kinds = (pa.binary(), pa.binary(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.where(sizes > 0, sizes, 0), pa.int32()), *(pa.array(m, k) for m, k in zip(made, kinds))],
            [*batch.schema.names, "dim", "digest", "q", "scale", "lost"])


def coded(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding, label, dim, digest, q, scale, lost)`` of every row: the SHA-256 of its numbers
    and its quantised form.

    Vectors that link with nothing have a null embedding and digest, and the length 0.
    """
    usable = (F.col("label").isNotNull() & F.col("embedding").isNotNull()
              & F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
              & F.exists("embedding", lambda x: x != 0))
    slim = vectors.select("vec_id", F.when(usable, F.col("embedding")).alias("embedding"), "label")
    schema = T.StructType(slim.schema.fields + [
        T.StructField("dim", T.IntegerType()), T.StructField("digest", T.BinaryType()), T.StructField("q", T.BinaryType()),
        T.StructField("scale", T.DoubleType()), T.StructField("lost", T.DoubleType())])
    return slim.mapInArrow(_coded, schema)


def classes(rows: DataFrame) -> DataFrame:
    """Distinct usable vectors of each label: ``(c, label, dim, digest, q, scale, lost, copies, first, row)`` with a
    number ``c`` of their own, how many rows hold them, the smallest of their vec_id and one of their rows.

    Copies meet before anything is compared, combined before the exchange.
    """
    return rows.filter("digest is not null").groupBy("label", "dim", "digest").agg(
        *(F.any_value(x).alias(x) for x in ("q", "scale", "lost")),
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"), F.min("row").alias("row")) \
        .withColumn("c", F.monotonically_increasing_id())


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``(vec_id, embedding, label)``.

    Rows are linked if their labels are equal and not null, their lengths are equal and their cosine
    reaches the threshold.  A vector that is null, empty, zero or holds a null or non-finite component
    links with nothing and is its own component.  Each repeated row counts as a vector; those with the
    smallest vec_id of a component are all kept.  A null vec_id is the smallest only where there is no other.
    """
    rows = materialise(coded(vectors).withColumn("row", F.monotonically_increasing_id()), "vectors")
    found = materialise(classes(rows), "classes")
    height = F.least(F.lit(TILE), F.ceil(F.lit(COMPONENTS) / F.col("dim")))
    sizes = found.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).select(
        "label", "dim", F.ceil(F.col("n") / height).cast("int").alias("tiles"))
    # Each vector of a label meets all of its tiles.
    small = found.join(sizes, ["label", "dim"]).select(
        "label", "dim", F.pmod(F.xxhash64("c"), "tiles").cast("int").alias("tile"), "tiles", "c", "copies", "q", "scale", "lost")
    tiled = (small.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .withColumn("ti", F.least("tile", "other")).withColumn("tj", F.greatest("tile", "other")).drop("tiles", "other"))
    sure = materialise(tiled.groupBy("label", "dim", "ti", "tj").applyInArrow(
        _by_bounds(threshold), "ti int, tj int, a bigint, b bigint, links bigint, open boolean"), "sure")
    # Open rows get their full vectors, one per row and not per pair of tiles, before they are dealt again.
    opened = sure.filter("open").select(F.col("a").alias("c"), "ti", "tj")
    full = rows.select("row", "embedding").join(
        small.join(found.select("c", "row"), "c").join(opened.select("c").distinct(), "c", "left_semi"), "row").drop("row", "tiles")
    exact = full.join(opened, "c").groupBy("label", "dim", "ti", "tj").applyInArrow(
        _in_full(threshold), "a bigint, b bigint, links bigint")
    links = materialise(sure.filter("links > 0").select("a", "b", "links").unionByName(exact), "links")
    roots = components(links.select("a", "b")).select(F.col("node").alias("c"), "root")
    counts = links.groupBy(F.col("a").alias("c")).agg(F.sum("links").alias("links"))
    rooted = found.select("c", "label", "dim", "digest", "copies", "first").join(roots, "c", "left").join(counts, "c", "left") \
        .withColumn("root", F.coalesce("root", "c"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(smallest, "root").select("label", "dim", "digest", "component", (
        F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("links"))
    component = F.coalesce("component", "vec_id")
    return (rows.select("vec_id", "label", "dim", "digest").join(named, ["label", "dim", "digest"], "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")))


# The cosine of every pair of one label, and what can be reached by links.
OP3_SQL = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.v) = len(b.v) AND CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= {THRESHOLD} ELSE false END),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
smallest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN smallest s ON s.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""


def op3_embeddings(spark, sf_dir):
    """All vectors."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
