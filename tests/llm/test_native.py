import hashlib
import math
import re
import zlib

import pytest

import oracle_check
from lexitab.llm import decontamination, license_texts, licenses, sharding
from lexitab.llm.license_texts import MIT, known
from lexitab.llm.queries import ORACLES, QUERIES

DOCS = "doc_id bigint, text string, shard string, _doc int, item_id string"
ITEMS = "item_id bigint, text string, doc_id string"


@pytest.fixture(scope="module")
def duck():
    return oracle_check.connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, duck, name):
    frame = QUERIES[name](spark, "/root/testdata/sf0.001")
    twin = duck.execute(ORACLES[name])
    assert oracle_check.type_difference(frame.dtypes, twin.description) is None
    assert oracle_check.difference(frame.toPandas(), twin.fetch_df()) is None


@pytest.mark.parametrize("name", ["op1_licenses", "op2_sharding", "op9_decontamination"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# --- licences ---------------------------------------------------------------------------------

def scanned(spark, rows, pairs=None):
    docs = spark.createDataFrame(rows, DOCS)
    texts = licenses.known_licenses(spark) if pairs is None else spark.createDataFrame(pairs, "license_id string, text string")
    return sorted(((r.doc_id, r.scope, r.line_no, r.license_id) for r in licenses.scan(docs, texts).collect()), key=str)


def doc(doc_id, text):
    return doc_id, text, "x", 0, "x"


def test_a_licence_is_known_in_any_dress(spark):
    dressed = ("/*\n * Copyright (c) 2020-2024 Some One <a@b.c>\n * © Another\n * All rights reserved.\n *\n"
               + MIT.upper().replace("SUBLICENSE", "sub-licence").replace('"AS IS"', "“as is”").replace(" ", "   ") + "\n */")
    rows = [doc(1, dressed), doc(2, MIT + " And more."), doc(3, "Some words.\n# released under the M.I.T. license\nThe end.")]
    found = scanned(spark, rows, [("MIT", MIT), ("MIT", "Released under the M I T Licence")])
    assert (1, "text", 0, "MIT") in found and (2, "text", 0, None) in found
    assert (3, "text", 0, None) in found and (3, "line", 2, "MIT") in found
    assert len(found) == 4


def test_only_the_copyright_statement_is_cut(spark):
    one_line = " ".join(MIT.split())
    heads = ["Copyright (c) 2024 X. ", "Copyright (c) 2024 X ", "// Copyright 2020-2024 John D. Roe, Foo Inc. and others. All rights reserved. ",
             "(c) 2020 A. Copyright (C) 2021 B <b@c.de>. ", "© Some One. ", "Copyright (c) 2024 Foo, Inc. ", "(c) Some One, 2020. "]
    rows = [doc(i, head + one_line) for i, head in enumerate(heads)]
    rows += [doc(20, "Copyright (c) 2020 X. Licensed under the MIT License."), doc(21, "Copyright (c) 2020 X, licensed under the MIT License"),
             doc(22, "(c) 2020 A\n(C) Copyright B\n© C\n(c) Some One <a@b.c>\r\n# Copyright by D.\nAll rights reserved.\n" + MIT),
             doc(23, "All rights reserved. " * 20_000 + one_line)]
    found = scanned(spark, rows)
    assert [f for f in found if f[1] == "text"] == sorted([(r[0], "text", 0, "MIT") for r in rows], key=str)
    assert (20, "line", 1, "MIT") in found and (21, "line", 1, "MIT") in found


def test_a_clause_with_the_number_c_is_no_copyright_line(spark):
    clauses = "You may copy it, if\n(a) you keep this notice;\n(b) you mark changes;\n{}\n(d) you pay nothing."
    forms = ["(c) You must retain all notices.", "(c) You must not retain them.", "(C) YOU MUST RETAIN IT", "(c) in 2020 you pay 5."]
    docs = spark.createDataFrame([doc(i, clauses.format(c)) for i, c in enumerate(forms)], DOCS)
    made = [r.words for r in docs.orderBy("doc_id").select(licenses.canonical(docs.text).alias("words")).collect()]
    assert [" c " in w for w in made] == [True] * 4 and len(set(made)) == 4
    found = scanned(spark, [doc(1, clauses.format(forms[0])), doc(2, clauses.format(forms[1]))], [("L", clauses.format(forms[0]))])
    assert found == [(1, "text", 0, "L"), (2, "text", 0, None)]


def test_long_licences_are_known_whole(spark):
    texts = {path.stem: path.read_text() for path in license_texts.FILES.glob("*.txt")}
    assert set(texts) == {"Apache-2.0", "MPL-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-3.0-only", "CC0-1.0", "Unlicense"}
    rows, want = [], []
    for i, (name, text) in enumerate(sorted(texts.items())):
        forms = [text, " * " + text.upper().replace("\n", "\n * "), text.replace("http://", "https://"),
                 text.replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2020-2024 Some One"),
                 text.split("END OF TERMS")[0], text + "\nAnd more."]
        rows += [doc(10 * i + j, form) for j, form in enumerate(forms)]
        want += [(10 * i + j, name if j < 5 else None) for j in range(6)]
    rows.append(doc(100, texts["Unlicense"] + "\nFor more information, please refer to <https://unlicense.org>\n"))
    found = [(f[0], f[3]) for f in scanned(spark, rows) if f[1] == "text"]
    assert sorted(found) == want + [(100, "Unlicense")]


def test_odd_licence_rows(spark):
    rows = [doc(1, None), doc(2, ""), doc(3, "...\n\n"), doc(None, "MIT License"), doc(4, "MIT License"), doc(4, "MIT License"),
            doc(5, "word " * 70_000)]
    both = [(i, s, n, "MIT") for i in (None, 4, 4) for s, n in (("text", 0), ("line", 1))]
    want = [(i, "text", 0, None) for i in (1, 2, 3, 5)] + both
    assert scanned(spark, rows) == sorted(want, key=str)
    assert scanned(spark, rows, [("A", None), ("B", ""), ("C", "?!")]) == sorted(
        [(r[0], "text", 0, None) for r in rows], key=str)
    assert scanned(spark, [], None) == []
    assert len(scanned(spark, rows, [])) == len(rows)


def test_known_licences_have_one_id_each(spark):
    ids = licenses.digests(licenses.known_licenses(spark)).collect()
    assert len({r.digest for r in ids}) == len(ids) and {r.license_id for r in ids} == {i for i, _ in known()}


# --- shards -----------------------------------------------------------------------------------

def best_shard(doc_id, weights):
    key = "" if doc_id is None else str(doc_id)
    u = [(int(hashlib.md5(f"{key}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 16 ** 13 for i in range(len(weights))]
    scores = [-w / math.log(x) for w, x in zip(weights, u)]
    return scores.index(max(scores))


def test_shards_by_brute_force(spark):
    rows = [doc(i, f"text {i} é") for i in range(300)]
    rows += [doc(None, None), doc(None, ""), doc(7, "same"), doc(7, "same"), doc(7, "same"), doc(400, "x" * 200_000)]
    weights, added = [1.0, 2.0, 0.5, 1.0], [3.0]
    found = sharding.shard_documents(spark.createDataFrame(rows, DOCS).repartition(5), weights, added).collect()
    assert len(found) == len(rows)
    text_of = {r[0]: r[1] for r in rows}
    for r in found:
        assert r.shard == best_shard(r.doc_id, weights) and r.grown_shard == best_shard(r.doc_id, weights + added)
        assert r.grown_shard in (r.shard, 4)
        if r.doc_id not in (7, None):
            assert r.text_crc32 == zlib.crc32(text_of[r.doc_id].encode()) and r.size == len(text_of[r.doc_id].encode()) + 1
        if r.doc_id is None:
            assert (r.text_crc32, r.size) == (0, 1)
    for shard in range(4):
        mine = sorted((r for r in found if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        order = [(-1 if r.doc_id is None else r.doc_id, r.text_crc32, r.size) for r in mine]
        assert order == sorted(order)


def test_shards_follow_their_weights(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "doc_id")
    counts = {r.shard: r["count"] for r in sharding.rendezvous(keys, "doc_id", [1.0, 3.0]).groupBy("shard").count().collect()}
    assert abs(counts[1] / 20_000 - 0.75) < 0.02


def test_slots_beside_columns_of_any_name(spark):
    rows = spark.createDataFrame([(i, 5, 6, i % 3, 7, 8) for i in range(30)], "doc_id int, _row int, pos int, shard int, slot int, pid int")
    got = sharding.with_slots(rows, ["doc_id"]).collect()
    assert {(r._row, r.pos, r.pid) for r in got} == {(5, 6, 8)}
    assert sorted((r.shard, r.slot) for r in got) == [(s, n) for s in range(3) for n in range(10)]
    assert all(r.slot == r.doc_id // 3 for r in got)


def test_odd_shard_calls(spark):
    assert sharding.shard_documents(spark.createDataFrame([], DOCS), [1.0], [1.0]).count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous(spark.range(1), "id", [])
    with pytest.raises(ValueError):
        sharding.rendezvous(spark.range(1), "id", [1.0], [0.0])


# --- decontamination --------------------------------------------------------------------------

def split(text):
    return [w for w in re.sub(r"[^\w]|_", " ", (text or "").lower()).split()]


def contained_by_pairs(docs, items, threshold=0.8):
    """All pairs by the definition: documents by their id, items by their rows."""
    texts = {}
    for key, text in docs:
        texts.setdefault(key, []).append(split(text))
    hits = []
    for item, text in set(items):
        w = split(text)
        size = min(5, len(w))
        b = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if w else set()
        for d, rows in texts.items():
            a = {tuple(r[i:i + size]) for r in rows for i in range(len(r) - size + 1)}
            hits.append((d, item, len(b), len(a & b)))
    return sorted(((d, i, n, k, k / n) for d, i, n, k in hits if n and k >= threshold * n - 1e-9), key=str)


def test_passages_are_found_in_long_documents(spark):
    item = " ".join(f"w{i}" for i in range(40))
    worse = [f"w{i}" for i in range(40)]
    worse[3] = "x"
    half = [w if i < 20 else "y" for i, w in enumerate(f"w{j}" for j in range(40))]
    filler = " ".join(f"f{i}" for i in range(20_000))
    texts = [item, f"{filler} {item} {filler}", filler, " ".join(worse), " ".join(half), item.upper().replace(" ", ",\n"), None, "",
             "w0 w1 w2 w3", "w0 w1 w2 w3 w4"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, item), (None, "a"), (1, filler), (0, item)]
    items = [(0, item), (1, "w0 w1 w2 w3"), (2, None), (3, ""), (4, "w0 w1 w2 w3 w4"), (5, "A b. C d; e? f"), (5, "a b c d e f"),
             (6, item), (None, "f1 f2 f3 f4 f5 f6")]
    got = decontamination.contained(spark.createDataFrame([doc(*d) for d in docs], DOCS),
                                    spark.createDataFrame([(*i, "x") for i in items], ITEMS))
    want = contained_by_pairs(docs, items)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert {(w[0], w[1]) for w in want} >= {(0, 0), (1, 0), (3, 0), (5, 0), (None, 0), (0, 6), (9, 4), (8, 1)}
    kept = decontamination.decontaminate(spark.createDataFrame([doc(*d) for d in docs], DOCS),
                                         spark.createDataFrame([(*i, "x") for i in items], ITEMS))
    bad = {w[0] for w in want}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((d[0] for d in docs if d[0] not in bad), key=str)


def test_sketches_lose_no_pair(spark):
    """Items of many sizes, each with exactly as many shingles missing as may be."""
    docs, items = [], []
    for n in range(5, 70):
        words = [f"i{n}x{j}" for j in range(n)]
        size = n - 4
        missing = size - math.ceil(0.8 * size - 1e-9)
        items.append((n, " ".join(words)))
        docs.append((n, " ".join(words[missing:])))
        docs.append((1000 + n, " ".join(words[missing + 1:])))
    got = decontamination.contained(spark.createDataFrame([doc(*d) for d in docs], DOCS),
                                    spark.createDataFrame([(*i, "x") for i in items], ITEMS))
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(n, n) for n in range(5, 70)]


def test_items_of_one_id_and_short_items(spark):
    long, other = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    items = [(None, long), (None, other), (None, "Paris, France"), (7, "x"), (7, "one two three four"), (7, "one two three four"), (7, "..."), (8, None)]
    docs = [(1, f"so {long} it is"), (2, "in paris  FRANCE!"), (3, "france paris"), (4, "xx"), (5, "(x)"), (6, "zero one two three four"),
            (7, "one two three"), (None, other), (8, f"{long} {other}")]
    got = decontamination.contained(spark.createDataFrame([doc(*d) for d in docs], DOCS),
                                    spark.createDataFrame([(*i, "x") for i in items], ITEMS))
    found = sorted((tuple(r) for r in got.collect()), key=str)
    assert found == contained_by_pairs(docs, items)
    assert sorted(f[0] for f in found if f[0]) == [1, 2, 5, 6, 8, 8]


def test_a_template_of_all_items_makes_no_pairs(spark):
    """Items that share most of their words: candidates are about as many as there are links."""
    template = " ".join(f"t{i}" for i in range(12))
    items = [(i, f"{template} q{i} r{i} s{i} u{i} v{i} w{i} x{i} y{i} z{i}") for i in range(300)]
    docs = [(i, f"some words {text} and more") for i, text in items] + [(1_000 + i, f"{template} only{i}") for i in range(300)]
    left = spark.createDataFrame([doc(*d) for d in docs], DOCS)
    right = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    parts = decontamination.item_shingles(right).cache()
    pairs = decontamination.candidates(left, parts, [5], 0.8).count()
    assert pairs <= 900
    assert sorted((r.doc_id, r.item_id) for r in decontamination.contained(left, right).collect()) == [(i, i) for i in range(300)]


def test_empty_decontamination(spark):
    none, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([doc(1, "a b c d e f")], DOCS)
    assert decontamination.contained(none, no_items).count() == 0
    assert decontamination.contained(some, no_items).count() == 0
    assert decontamination.decontaminate(some, no_items).count() == 1


def test_sketches_and_items_that_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_HASHES", 0)
    docs, items = [(1, "a b c d e f g"), (2, "b c d e f"), (3, "z")], [(1, "a b c d e f g")]
    got = decontamination.contained(spark.createDataFrame([doc(*d) for d in docs], DOCS),
                                    spark.createDataFrame([(*i, "x") for i in items], ITEMS))
    assert [(r.doc_id, r.item_id) for r in got.collect()] == [(1, 1)]


def test_rows_are_cleaned_by_their_own_text_whatever_their_ids(spark):
    item = " ".join(f"word{i}" for i in range(20))
    half, rest = " ".join(item.split()[:12]), " ".join(item.split()[8:])
    rows = [doc(None, "clean words"), doc(None, None), doc(None, half), doc(None, rest), doc(None, "So " + item), doc(7, half), doc(7, rest),
            doc(7, item + " it is"), doc(7, "clean words"), doc(7, "clean words"), doc(8, item), doc(9, "more clean words")]
    docs = spark.createDataFrame(rows, DOCS)
    kept = decontamination.decontaminate_rows(docs, spark.createDataFrame([("a", item, "x")], "item_id string, text string, doc_id string"))
    assert kept.schema == docs.schema
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if item not in (r.text or ""))
