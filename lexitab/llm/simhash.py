"""SimHash near-duplicates found with pivot distance tables.

The Hamming distances of a fingerprint to fixed reference fingerprints (pivots) differ by no more than
the distance of two fingerprints, for every pivot.  So a pair whose distances to any pivot differ by
more than the limit is discarded, and only the others are compared bit by bit.

Distances to references lie close together (32 +- 4 of 64 bits), so they discard pairs but cannot name
partitions.  Those come from the pigeonhole rule: with at most 3 different bits, 3 of 6 blocks of bits
are equal.  Each of the 20 choices of 3 blocks is a key of 31 to 33 bits, and pairs meet under a key.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lexitab.llm.columns import unused
from lexitab.llm.components import components, forest
from lexitab.llm.memory import release
from lexitab.plans.fixtures import table
from lexitab.session import materialise

SHINGLE, SEED, BITS, LIMIT = 3, 42, 64, 3
BLOCKS, EQUAL = 6, 3
PIVOTS = 16
# Fingerprints of one key that are compared in one task; a key with more is cut into pairs of tiles.
TILE = 2_048
# Fingerprints whose pairs are formed at a time.
CHUNK = 65_536
HASHES = 65_536


def fingerprint(text: str | None) -> int:
    """The SimHash of the text's 3-word shingles, as a signed 64-bit number; 0 without words.

    Only A-Z are folded and only ASCII blanks part words, so bytes do what the definition asks.
    """
    words = [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles, n = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))), len(words) - SHINGLE + 1
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, n, HASHES):
        size = min(HASHES, n - start)
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s, _ in zip(shingles, range(size))),
                             dtype="<u8", count=size)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = pa.array([fingerprint(t.as_py()) for t in batch.column("text")], pa.int64())
        others = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in others), values], [*others, "fp"])
    release()


def fingerprints(docs: DataFrame, *extra: Column) -> DataFrame:
    """``(doc_id, *extra, fp)`` of every row."""
    slim = docs.select("doc_id", *extra, "text")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1]]
    return slim.mapInArrow(_fingerprints, ", ".join([*fields, "fp bigint"]))


def _masks() -> list[int]:
    """A mask for each choice of equal blocks, as signed numbers."""
    edges = [BITS * i // BLOCKS for i in range(BLOCKS + 1)]
    block = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(BLOCKS)]
    masks = [sum(chosen) for chosen in combinations(block, EQUAL)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Distances of fingerprints to the pivots, one column each; pivots are hashes of their numbers."""
    pivots = np.array([xxhash.xxh64_intdigest(str(i)) for i in range(PIVOTS)], dtype=np.uint64)
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)


def _close(fps: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of one run that differ in at most LIMIT bits.

    Runs are contiguous; pairs are formed by their distance in the array, for all runs at once.
    """
    distances = pivot_table(fps)
    found_a, found_b = [], []
    step, left = 1, np.arange(len(fps))
    while True:
        left = left[left + step < len(fps)]
        left = left[run[left] == run[left + step]]
        if not len(left):
            break
        a = left
        for pivot in range(PIVOTS):
            column = distances[:, pivot]
            a = a[np.abs(column[a] - column[a + step]) <= LIMIT]
        a = a[np.bitwise_count(fps[a] ^ fps[a + step]) <= LIMIT]
        found_a.append(a)
        found_b.append(a + step)
        step += 1
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect what pairs of equal key connect; rows come sorted by their key.

    Of each chunk only a forest leaves: as many links as fingerprints at most, however many pairs.
    """
    def linked(keys: list[np.ndarray], fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.ones(len(fps), dtype=bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        run = np.cumsum(new)
        again = np.bincount(run)[run] > 1
        fps, run = fps[again], run[again]
        a, b = _close(fps.view(np.uint64), run)
        root = forest(a, b, len(fps))
        hung = np.flatnonzero(root != np.arange(len(fps)))
        if len(hung):
            yield pa.RecordBatch.from_arrays([pa.array(fps[hung]), pa.array(fps[root[hung]])], ["a", "b"])

    names = ["choice", "key", "ti", "tj"]
    kept: list[np.ndarray] | None = None
    for batch in batches:
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in [*names, "fp"]]
        if kept is not None:
            columns = [np.concatenate(pair) for pair in zip(kept, columns)]
        kept = columns
        if len(columns[0]) < CHUNK:
            continue
        same = np.all([c == c[-1] for c in columns[:4]], axis=0)
        cut = int(len(same) - np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield from linked([c[:cut] for c in columns[:4]], columns[4][:cut])
            kept = [c[cut:] for c in columns]
    if kept is not None and len(kept[0]):
        yield from linked(kept[:4], kept[4])


def near_links(classes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` with the same components as all pairs of fingerprints within LIMIT bits.

    ``classes`` holds every fingerprint ``fp`` once.  A key that more than TILE fingerprints share is
    compared tile by tile, so no task meets an unbounded group.
    """
    choices = F.array(*(F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                        for i, m in enumerate(_masks())))
    keyed = classes.select("fp", F.inline(choices))
    counts = keyed.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    counts = materialise(counts.withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int")), "keys")
    shared = keyed.join(counts.drop("n"), ["choice", "key"])
    tile = F.pmod(F.xxhash64("fp"), "tiles").cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    tiled = shared.withColumn("tile", tile).withColumn("other", other).select(
        "choice", "key", F.least("tile", "other").alias("ti"), F.greatest("tile", "other").alias("tj"), "fp")
    group = ["choice", "key", "ti", "tj"]
    return tiled.repartition(*group).sortWithinPartitions(*group).mapInArrow(_links, "a bigint, b bigint")


def _rooted(classes: DataFrame) -> DataFrame:
    """Classes with the ``root`` fingerprint of their component."""
    roots = components(near_links(classes.select("fp"))).withColumnRenamed("node", "fp")
    return classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row of ``docs``.

    Rows with fingerprints at most 3 bits apart are linked, and ``component_id`` is the smallest doc_id
    that can be reached.  Null and empty texts have the fingerprint 0 and are linked like any other;
    a null doc_id is never the smallest unless there is no other.  Copies meet in one fingerprint
    before anything is compared, so a group of copies of any size is one row there.
    """
    prints = materialise(fingerprints(docs), "fingerprints")
    classes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    rooted = _rooted(classes)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of every group of near-duplicates with all its columns: that of the smallest doc_id.

    A null doc_id comes last, rows of one doc_id go by the hash of their text, and of repeats of that
    row any one stays.  No text is moved unless the chosen row has repeats.
    """
    text = F.xxhash64("text")
    prints = materialise(fingerprints(docs, text.alias("h")), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("first")
    classes = materialise(prints.groupBy("fp").agg(first), "classes")
    best = _rooted(classes).groupBy("root").agg(F.min("first").alias("first"))
    names = [unused(docs, name) for name in ("_doc", "_h", "_n")]
    doc, h, n = map(F.col, names)
    chosen = best.select(F.col("first.doc_id").alias(names[0]), F.col("first.h").alias(names[1]))
    copies = F.col("doc_id").eqNullSafe(doc) & (F.col("h") == h)
    kept = prints.join(chosen, copies).groupBy(*names[:2]).agg(F.count(F.lit(1)).alias(names[2]))
    kept = materialise(kept, "kept")
    is_kept = F.col("doc_id").eqNullSafe(doc) & (text == h)
    single = docs.join(kept.filter(n == 1), is_kept, "left_semi")
    repeated = docs.join(kept.filter(n > 1), is_kept).dropDuplicates(names[:2])
    return single.unionByName(repeated.select(*docs.columns))


def op6_simhash(spark, sf_dir):
    """All documents."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
