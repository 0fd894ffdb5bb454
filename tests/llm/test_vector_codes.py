import hashlib
import math
import random

import numpy as np
import pytest

from lexitab.llm import vector_codes
from lexitab.plans.fixtures import table

SF = "/root/testdata/sf0.001"
ROWS = "vec_id bigint, embedding array<float>, label int, code string, n int"


def brute(rows, parts=16, entries=64, rounds=2):
    """Codes, errors, label errors and digest by the definition, in Python's whole numbers."""
    kept = [(i, v, label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    n = -(-max([len(v) for _, v, _ in kept], default=0) // parts)
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = []
    for _, v, _ in kept:
        ints = [math.floor(256 * x) for x in v] + [0] * (parts * n - len(v))
        cut.append([ints[p * n:(p + 1) * n] for p in range(parts)])
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            ds = [[sum((a - b) ** 2 for a, b in zip(c[p], e)) for e in books[p]] for p in range(parts)]
            out.append([(d.index(min(d)), min(d)) for d in ds])
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, f in zip(cut, found) if f[p][0] == e]
                if mine:
                    books[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    found = assign()
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for _, d in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    return sorted(((i, "".join(f"{e:02x}" for e, _ in f), error, by_label[label], sha)
                   for (i, _, label), f, error in zip(kept, found, errors)), key=str)


def found(spark, df):
    vectors = vector_codes.usable(df)
    books = vector_codes.codebooks(vectors)
    coded = vector_codes.with_label_error(vector_codes.encode(vectors, books))
    return sorted(((r.vec_id, r.code, r.error, r.label_error, vector_codes.digest(books)) for r in coded.collect()), key=str)


def make(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], ROWS).repartition(3)


def test_codes_of_the_vectors(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, SF, "embeddings").collect()][:150]
    assert found(spark, make(spark, rows)) == brute(rows)


def test_ties_copies_nulls_and_unequal_lengths(spark):
    draw = random.Random(3)
    rows = [(i, [float(draw.randint(-2, 2)) / 64 for _ in range(48)], draw.choice([None, 1, 2])) for i in range(90)]
    rows += [(5, rows[5][1], 1), (None, [0.5] * 48, 2), (None, None, 2), (200, [math.nan] * 48, 1), (201, [math.inf] * 48, 1),
             (202, [0.25, None], 1), (203, [0.25, -0.125], 1), (204, [], None), (205, [0.0] * 50, 1)]
    assert found(spark, make(spark, rows)) == brute(rows)


def test_large_components_stay_exact(spark):
    draw = random.Random(4)
    rows = [(i, [float(np.float32(draw.choice([1e12, -3e12, 7.5, 2e5]) * draw.random())) for _ in range(16)], 1) for i in range(80)]
    got, want = found(spark, make(spark, rows)), brute(rows)
    assert [(g[0], g[1], g[4]) for g in got] == [(w[0], w[1], w[4]) for w in want]
    assert [g[2] for g in got] == [min(w[2], vector_codes.LONG) for w in want]
    with pytest.raises(ValueError):
        vector_codes.codebooks(make(spark, [(1, [1e30], 1)]))


def test_few_rows_and_none(spark):
    few = [(2, [1.0] * 16, 1), (1, [0.0] * 16, 1)]
    assert found(spark, make(spark, few)) == brute(few)
    assert found(spark, make(spark, [])) == []
    assert found(spark, make(spark, [(1, None, 1)])) == []


@pytest.mark.parametrize("width", [1, 2, 3, 4, 6, 8, 13])
def test_nearest_entries_by_brute_force(width):
    draw = np.random.default_rng(width)
    parts, book = draw.integers(-300, 300, (500, width)), draw.integers(-300, 300, (40, width))
    book[7], parts[:5] = book[3], book[3]
    squares = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    codes, best = vector_codes.nearest(parts, book)
    assert (codes == squares.argmin(axis=1)).all() and (best == squares.min(axis=1)).all()
    codes, best = vector_codes.nearest(parts.astype(object), book.astype(object))
    assert (codes == squares.argmin(axis=1)).all() and (best == squares.min(axis=1)).all()


def test_sequency_order():
    walsh = vector_codes.hadamard(8)
    assert [(r[1:] != r[:-1]).sum() for r in walsh] == list(range(8))
    assert (walsh @ walsh.T == 8 * np.eye(8)).all()


def test_codes_stand_for_vectors(spark):
    vectors = vector_codes.usable(table(spark, SF, "embeddings"))
    books = vector_codes.codebooks(vectors)
    coded = vector_codes.encode(vectors, books)
    back = {r.vec_id: np.array(r.embedding) for r in vector_codes.decode(coded, books).collect()}
    for r in coded.join(vectors, "vec_id").collect():
        exact = np.floor(np.array(r.embedding) * 256)
        assert int(((exact - back[r.vec_id] * 256) ** 2).sum()) == r.error
