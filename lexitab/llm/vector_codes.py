"""Vector codes: product quantisation in whole numbers by an integer Walsh-Hadamard transform.

Parts of vectors and entries of codebooks are padded with zeros to a power of two ``w`` and transformed.
The transform multiplies every squared distance by ``w`` exactly, and with rows in sequency order most of
the distance is in the first few coefficients.  So squared differences are summed coefficient by
coefficient, and an entry whose sum already exceeds the full distance of another entry is eliminated.
All numbers are whole: no rounding decides anything.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexitab.llm.columns import unused
from lexitab.plans.fixtures import table
from lexitab.session import materialise

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
# Squared distances that are held at a time.
BLOCK = 1 << 20
# Components beyond this are refused: their sums would leave 38 decimal digits.
LARGEST = 1e25
LONG = (1 << 63) - 1


def hadamard(width: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of a power of two, rows by their number of sign changes."""
    rows = np.ones((1, 1), dtype=np.int64)
    while len(rows) < width:
        rows = np.block([[rows, rows], [rows, -rows]])
    return rows[np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")]


def transformed(parts: np.ndarray) -> np.ndarray:
    """Whole numbers ``(..., n)`` as Walsh-Hadamard coefficients ``(..., w)``, the first with no sign change."""
    n = parts.shape[-1]
    walsh = hadamard(1 << max(0, n - 1).bit_length())
    return parts @ walsh[:, :n].T.astype(parts.dtype)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of ``book (entries, n)`` for every row of ``parts (rows, n)``, and its squared
    distance; of equal ones the lower index."""
    of_parts, of_book = transformed(parts), transformed(book)
    entries, width = of_book.shape
    codes, best = np.empty(len(parts), dtype=np.int64), np.empty(len(parts), dtype=parts.dtype)
    for start in range(0, len(parts), max(1, BLOCK // entries)):
        rows = of_parts[start:start + max(1, BLOCK // entries)]
        first = (rows[:, :1] - of_book[None, :, 0]) ** 2
        # The full distance of the entry that leads after one coefficient is a bound for all others.
        leader = of_book[np.argmin(first, axis=1)]
        bound = ((rows - leader) ** 2).sum(axis=1)
        row, entry = np.nonzero(first <= bound[:, None])
        so_far = first[row, entry]
        for i in range(1, width):
            so_far = so_far + (rows[row, i] - of_book[entry, i]) ** 2
            alive = so_far <= bound[row]
            row, entry, so_far = row[alive], entry[alive], so_far[alive]
        # Entries of a row ascend, so the first one at the least distance has the lower index.
        starts = np.searchsorted(row, np.arange(len(rows)))
        least = np.minimum.reduceat(so_far, starts)
        at_least = np.flatnonzero(so_far == least[row])
        chosen = at_least[np.searchsorted(row[at_least], np.arange(len(rows)))]
        codes[start:start + len(rows)] = entry[chosen]
        best[start:start + len(rows)] = least // width
    return codes, best


def whole(lists: pa.ListArray, scale: int, width: int) -> np.ndarray:
    """Vectors as rows of ``width`` whole numbers ``floor(scale * x)``, zeros behind shorter ones.

    64-bit numbers where no square or sum can leave them, else Python's own.
    """
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(values) and np.abs(values).max() > LARGEST:
        raise ValueError(f"a component beyond {LARGEST:g}")
    scaled = np.floor(values * scale)
    most = np.abs(scaled).max(initial=0)
    exact = 2 * most * max(1, width) < 2 ** 30
    numbers = scaled.astype(np.int64) if exact else np.array([int(x) for x in scaled], dtype=object)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), dtype=numbers.dtype)
    out[np.arange(width)[None, :] < sizes[:, None]] = numbers
    return out


def _encode(batch: pa.RecordBatch, books: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(parts, codes, distances)`` of a batch; codebooks are ``(part, entry, component)``."""
    count, _, n = books.shape
    numbers = whole(batch.column("embedding"), scale, count * n)
    parts = numbers.reshape(len(numbers), count, n)
    small = parts.dtype == np.int64 and 2 * max(map(abs, books.flat), default=0) * max(1, count * n) < 2 ** 30
    kind = np.int64 if small else object
    parts, books = parts.astype(kind), books.astype(kind)
    found = [nearest(parts[:, p], books[p]) for p in range(count)]
    return parts, np.stack([c for c, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _sums(books: np.ndarray, scale: int):
    """Sums and counts of the parts that each entry gets: one row per entry and component from a task."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, entries, n = books.shape
        sums = np.zeros((count, entries, n), dtype=object)
        counts = np.zeros((count, entries), dtype=np.int64)
        for batch in batches:
            parts, codes, _ = _encode(batch, books, scale)
            for p in range(count):
                some = np.zeros((entries, n), dtype=parts.dtype)
                np.add.at(some, codes[:, p], parts[:, p])
                sums[p] += some
                counts[p] += np.bincount(codes[:, p], minlength=entries)
        p, e, i = np.nonzero(np.broadcast_to(counts[:, :, None] > 0, sums.shape))
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()), "i": pa.array(i, pa.int32()),
            "total": pa.array([int(x) for x in sums[p, e, i]], pa.decimal128(38)), "n": pa.array(counts[p, e], pa.int64())})
    return work


def _coded(books: np.ndarray, scale: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, codes, distances = _encode(batch, books, scale)
            errors = [min(LONG, int(x)) for x in distances.astype(object).sum(axis=1)] if distances.size else [0] * len(codes)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in batch.schema.names if n != "embedding"),
                 pa.array([bytes(row.tolist()).hex() for row in codes], pa.string()), pa.array(errors, pa.int64())],
                [*(n for n in batch.schema.names if n != "embedding"), "code", "error"])
    return work


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is not null and holds finite components only."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return vectors.filter(F.col("embedding").isNotNull() & finite)


def codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
              scale: int = SCALE) -> np.ndarray:
    """Codebooks ``(part, entry, component)`` of usable ``(vec_id, embedding)`` rows, in whole numbers.

    They start as the parts of the rows with the smallest vec_ids, nulls last, rows of one vec_id by their
    vectors; ``rounds`` times each entry becomes the floored mean of the parts nearest to it, if there are
    any.  Vectors are followed by zeros up to the least multiple of ``parts`` that holds the longest.  What
    reaches the driver has the size of the codebooks: tasks send sums, one row per entry and component.
    """
    length = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    n = -(-length // parts)
    first = (vectors.select("vec_id", "embedding").orderBy(F.col("vec_id").asc_nulls_last(), "embedding")
             .limit(entries).select("embedding").toArrow()["embedding"].combine_chunks())
    start = whole(first, scale, parts * n).reshape(len(first), parts, n)
    books = start.transpose(1, 0, 2).astype(object)
    for _ in range(rounds if len(first) and n else 0):
        sums = vectors.select("embedding").mapInArrow(
            _sums(books, scale), "part int, entry int, i int, total decimal(38,0), n bigint")
        for r in sums.groupBy("part", "entry", "i").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            books[r.part, r.entry, r.i] = int(r.total) // r.n
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.flat)).encode()).hexdigest()


def encode(vectors: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """The usable rows with all columns but ``embedding``, and ``code`` and ``error``.

    ``code`` holds the index of the nearest entry of every part, two hex digits each, and ``error`` the
    squared distances to them in all; one beyond a long is given as the largest long.  Columns that are
    named like these are replaced.  Codebooks go to the tasks with the job.
    """
    if not 0 <= books.shape[1] <= 256:
        raise ValueError("two hex digits hold 256 entries")
    kept = vectors.drop("code", "error")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "embedding"]
    return usable(kept).mapInArrow(_coded(books, scale), ", ".join([*fields, "code string", "error bigint"]))


def decode(codes: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``(vec_id, embedding)``: the vectors that the codes stand for, in doubles."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.concatenate([books[p][e] for p, e in enumerate(bytes.fromhex(c))]).astype(np.float64) / scale
                    if c else np.empty(0) for c in batch.column("code").to_pylist()]
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "embedding": pa.array(rows, pa.list_(pa.float64()))})
    kind = codes.schema["vec_id"].dataType.simpleString()
    return codes.select("vec_id", "code").mapInArrow(work, f"vec_id {kind}, embedding array<double>")


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the errors of all rows of equal label, nulls together.

    Sums are combined before their exchange and there is one per label, so a hot label is on the rows'
    side of the join only.  A sum beyond a long is given as the largest long.
    """
    name, total = unused(coded, "_label"), F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy(F.col("label").alias(name)).agg(F.least(total, F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return coded.drop("label_error").join(sums, F.col("label").eqNullSafe(F.col(name)), "left").drop(name)


def op13_vector_codes(spark, sf_dir):
    """All vectors: 16 parts, 64 entries each, two rounds."""
    vectors = usable(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    books = codebooks(vectors)
    coded = with_label_error(materialise(encode(vectors, books), "codes"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _assigned(books: str) -> str:
    """SQL: the nearest entry ``e`` of every part and its squared distance ``d``."""
    return f"""SELECT vec_id, p, min(d * 64 + e) % 64 AS e, min(d * 64 + e) // 64 AS d FROM (
        SELECT vec_id, parts.p, e, CAST(list_sum(list_transform(list_zip(v, b), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM parts JOIN {books} USING (p)) GROUP BY vec_id, p"""


def _updated(books: str, assigned: str) -> str:
    return f"""SELECT p, e, coalesce(m, b) AS b FROM {books} LEFT JOIN (
        SELECT p, e, list(CAST((total - (total % n + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM (
            SELECT p, e, i, sum(x) AS total, count(*) AS n
            FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM parts JOIN {assigned} USING (vec_id, p))
            GROUP BY p, e, i) GROUP BY p, e) USING (p, e)"""


OP13_SQL = f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
    SELECT vec_id, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS v FROM kept, range(16) r(p)),
b0 AS MATERIALIZED (SELECT p, e, v AS b FROM parts JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64) USING (vec_id)),
a0 AS MATERIALIZED ({_assigned('b0')}),
b1 AS MATERIALIZED ({_updated('b0', 'a0')}),
a1 AS MATERIALIZED ({_assigned('b1')}),
b2 AS MATERIALIZED ({_updated('b1', 'a1')}),
a2 AS MATERIALIZED ({_assigned('b2')}),
coded AS (
    SELECT vec_id, string_agg(lower(lpad(hex(e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(x, ',' ORDER BY p, e, i)) FROM (
        SELECT p, e, CAST(unnest(b) AS VARCHAR) AS x, generate_subscripts(b, 1) AS i FROM b2)) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""
