import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexitab.llm import packing
from lexitab.plans.fixtures import table

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(packing.VOCABULARY)


def padding(sizes, capacity=packing.CAPACITY):
    return sum(0 if n & (n - 1) == 0 else capacity - n for n in sizes)


def checked(pieces, ids_of, capacity=packing.CAPACITY):
    """Every id of every document lies in one piece, sequences have no gap and are not too long."""
    by_sequence, by_doc = {}, {}
    for doc, start, length, tokens, sequence, offset, crc in pieces:
        assert length > 0 and crc == zlib.crc32(np.array(ids_of[doc][start:start + length], dtype="<u4").tobytes())
        assert tokens == len(ids_of[doc])
        by_sequence.setdefault(sequence, []).append((offset, length))
        by_doc.setdefault(doc, []).append((start, length))
    for doc, ids in ids_of.items():
        at = 0
        for start, length in sorted(by_doc[doc]):
            assert start == at
            at += length
        assert at == len(ids)
    sizes = []
    for some in by_sequence.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= capacity
        sizes.append(at)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return sizes


def test_pieces_of_the_documents(spark):
    library = Tokenizer.from_file(PATH)
    ids_of = {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 1] for r in table(spark, SF, "documents").collect()}
    found = packing.op12_packing(spark, SF).select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32")
    sizes = checked(map(tuple, found.collect()), ids_of)
    assert padding(sizes) <= 0.01 * sum(sizes)


def test_odd_rows_and_sequences(spark):
    rows = [(1, "word " * 30_000, "x", 1), (2, None, "x", 1), (3, "", "x", 1), (None, "a b", "x", 1), (None, "a b", "x", 1), (4, "c", "x", 1),
            (4, "c", "x", 1), (5, "a " * 2_047, "x", 1), (6, "a " * 4_095, "x", 1), (7, "a " * 1_023, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, doc string, offset int").repartition(3)
    library = Tokenizer.from_file(PATH)
    pieces = packing.pack(docs, PATH, 9).cache()
    want = sorted((str(d), [*library.encode(t or "", add_special_tokens=False).ids, 9]) for d, t, *_ in rows)
    assert sum(r.length for r in pieces.collect()) == sum(len(ids) for _, ids in want)
    for r in pieces.collect():
        assert any(str(r.doc_id) == d and r.doc_tokens == len(ids) and ids[r.start:r.start + r.length] == list(r.ids) for d, ids in want)
    made = {r.sequence_id: list(r.ids) for r in packing.sequences(pieces).collect()}
    for r in pieces.collect():
        assert made[r.sequence_id][r.offset:r.offset + r.length] == list(r.ids)
    assert sum(map(len, made.values())) == sum(len(ids) for _, ids in want) and max(map(len, made.values())) <= packing.CAPACITY
    assert padding(map(len, made.values())) == 0
    assert packing.pack(spark.createDataFrame([], docs.schema), PATH).count() == 0


def histograms():
    draw = np.random.default_rng(2)
    yield np.bincount(draw.integers(0, 2_048, 5_000), minlength=2_048)
    yield np.bincount(np.minimum(2_047, draw.lognormal(5.5, 1, 20_000).astype(int) + 1), minlength=2_048)
    for lengths in ({1_100: 1_000}, {700: 5_000, 648: 500}, {1: 1}, {2_047: 3}, {0: 4}, {}, {1_024: 7, 512: 3, 5: 100}):
        h = np.zeros(2_048, dtype=np.int64)
        for length, n in lengths.items():
            h[length] = n
        yield h


@pytest.mark.parametrize("histogram", list(histograms()))
def test_places_of_any_histogram(histogram):
    """All tokens of all tails, each sequence filled once; whole tails cost little padding."""
    lengths = np.repeat(np.arange(2_048), histogram)
    places = packing.Places(histogram)
    found = places.pieces(np.arange(len(lengths)), lengths)
    by_sequence = {}
    for length, pieces in zip(lengths.tolist(), found):
        assert [p[0] for p in pieces] == np.cumsum([0, *(p[1] for p in pieces)])[:-1].tolist() and sum(p[1] for p in pieces) == length
        for _, n, sequence, slot in pieces:
            by_sequence.setdefault(sequence, []).append((slot, n))
    assert sorted(by_sequence) == list(range(places.sequences))
    for some in by_sequence.values():
        some.sort()
        assert all(a + n <= b for (a, n), (b, _) in zip(some, some[1:])) and sum(n for _, n in some) <= 2_048
    sizes = [sum(n for _, n in some) for some in by_sequence.values()]
    assert padding(sizes) <= 0.01 * max(1, lengths.sum())


def test_patterns_never_take_more_than_there_is():
    draw = random.Random(1)
    for _ in range(40):
        capacity = draw.choice([8, 16, 64])
        histogram = np.array([draw.randint(0, 6) for _ in range(capacity)])
        used = np.zeros(capacity, dtype=int)
        for p in packing.patterns(histogram, capacity):
            assert p.lengths @ p.copies <= capacity
            used[p.lengths] += p.copies * p.sequences
        assert (used <= histogram).all()


def test_program_reaches_the_bound():
    """Against all patterns of a small capacity: no cheaper cover of the demand exists than the bound of its prices."""
    draw = np.random.default_rng(5)
    for _ in range(10):
        demand = draw.integers(1, 40, 15)
        lengths = np.arange(1, 16)
        program = packing._Program(lengths, demand, 16)
        program.solve(demand)
        worth, _ = program.knapsack()
        ratio = max(1.0, worth.max() / 16, (program.price / (lengths * (1 + packing.CUT_COST))).max())
        assert program.price @ demand * (1 - 1 / ratio) <= 1e-6 + packing.GAP * packing.CUT_COST * (lengths @ demand)
        assert np.isclose(program.price @ demand, program.amount @ program.cost)
