import datetime
import glob
import os
import random

import pytest

import models
from lexitab.operators import ranges
from lexitab.plans import build, ranged

DAY = datetime.datetime(2024, 5, 1)
ORD = "title string, value string, ord struct<file: string, block: bigint, row: bigint>"


def put(spark, pairs):
    return spark.createDataFrame([(t, v, ("", 0, i)) for i, (t, v) in enumerate(pairs)], ORD).repartition(3)


def live(spark, root):
    return [(r.title, r.value) for r in ranged.rows(spark, root).orderBy("seq", "row").collect()]


def data_files(root):
    return {f: (os.stat(f).st_mtime_ns, os.stat(f).st_ino) for f in glob.glob(f"{root}/dict/*/rows.parquet/*/*.parquet")}


def checked(spark, root, want):
    """Rows, order, and both levels of the offsets are those of one CSV file."""
    assert live(spark, root) == want
    data, places = models.csv_bytes(want)
    found = sorted((r.byte_offset, r.byte_length, r.title) for r in ranged.index(spark, root).collect())
    assert found == sorted((o, n, t) for (t, _), (o, n) in zip(want, places))
    files = ranged.snapshot(spark, root).orderBy("seq").collect()
    assert [f.seq for f in files] == list(range(len(files))) and sum(f.rows for f in files) == len(want)
    assert all(a["last"] <= b["first"] for a, b in zip(files, files[1:]))


def test_five_keys_touch_few_files(spark, tmp_path):
    root = str(tmp_path)
    pairs = [(f"Key{i:04}", f"value {i}") for i in range(1_000)]
    made = ranged.create(spark, root, put(spark, pairs), now=DAY, num_parts=20)
    assert made.files == 20
    checked(spark, root, pairs)
    listed = {f.seq: f for f in ranged.snapshot(spark, root).collect()}
    changes = [("key0003", "new"), ("KEY0004", "new"), ("key0500", "x"), ("key0500b", "added"), ("zzz", "last")]
    hit = {s for t, _ in changes for s, f in listed.items() if f["first"] <= t.lower() <= f["last"]} | {19}
    assert len(hit) <= 4
    # Files that no key meets are damaged: whoever opened one would fail.
    intact = {}
    for seq, f in listed.items():
        if seq not in hit:
            path = os.path.join(root, f.file)
            intact[path] = open(path, "rb").read()
            open(path, "wb").write(b"no parquet")
    before = data_files(root)
    done = ranged.update(spark, root, put(spark, changes), now=DAY)
    assert done.read == len(hit) and done.rows == 1_002
    after = data_files(root)
    assert all(after[f] == stat for f, stat in before.items()) and len(after) - len(before) == done.written <= 8
    for path, content in intact.items():
        open(path, "wb").write(content)
    checked(spark, root, models.merge(pairs, changes)[0])
    kept = {f.file for f in ranged.snapshot(spark, root).collect()} & {f.file for f in listed.values()}
    assert kept == {f.file for s, f in listed.items() if s not in hit}


def test_random_updates_equal_one_merge_after_the_other(spark, tmp_path):
    draw, root = random.Random(11), str(tmp_path)
    keys = ["a", "A", "b", "B", "c", "ca", "é", "É", "hot", "HOT", "Hot", "z,", 'q"', "", "\U0001F600", "日本"]
    want = models.stable_sorted([(draw.choice(keys[:12]), f"v{i}\n" * (i % 3)) for i in range(300)] + [("hot", f"h{i}") for i in range(200)])
    ranged.create(spark, root, put(spark, want), now=DAY, num_parts=12)
    checked(spark, root, want)
    for size in (1, 3, 40, 0, 300):
        changes = [(draw.choice(keys), f"c{size}-{i}") for i in range(size)]
        done = ranged.update(spark, root, put(spark, changes), now=DAY, num_parts=draw.choice([1, 5, None]))
        want = models.merge(want, changes)[0]
        checked(spark, root, want)
        assert (done.read == 0) == (size == 0)
    last = {t: p for (t, _), p in zip(want, models.csv_bytes(want)[1])}
    assert {r.title: (r.byte_offset, r.byte_length) for r in ranged.live_entries(spark, root).collect()} == last


def test_empty_tables(spark, tmp_path):
    root = str(tmp_path)
    assert ranged.create(spark, root, put(spark, []), now=DAY).files == 0
    assert live(spark, root) == [] and ranged.index(spark, root).count() == 0
    ranged.update(spark, root, put(spark, [("b", "1"), ("a", "2")]), now=DAY)
    checked(spark, root, [("a", "2"), ("b", "1")])


def test_routes(spark):
    bounds = [("b", "d"), ("d", "d"), ("d", "f"), ("m", "p")]
    keys = spark.createDataFrame([(k,) for k in ["a", "b", "c", "d", "e", "g", "m", "z", "d"]], "k string")
    got = {r.k: (r.lo, r.hi) for r in ranges.route(keys, bounds).collect()}
    assert got == {"a": (0, 0), "b": (0, 0), "c": (0, 0), "d": (0, 2), "e": (2, 2), "g": (2, 2), "m": (3, 3), "z": (3, 3)}
    assert ranges.regions([0, 1, 2, 5, 7, 8]) == {0: 0, 1: 0, 2: 0, 5: 5, 7: 7, 8: 7}


def test_two_builds_at_once(spark, tmp_path, monkeypatch):
    """A second update starts and ends while the first one runs: the first is refused, nothing is lost."""
    root, real = str(tmp_path), ranged.upsert
    ranged.create(spark, root, put(spark, [("a", "1"), ("b", "1")]), now=DAY)
    inner = []

    def interleaved(*args, **options):
        if not inner:
            inner.append(None)
            inner[0] = ranged.update(spark, root, put(spark, [("b", "second")]), now=DAY)
        return real(*args, **options)

    monkeypatch.setattr(ranged, "upsert", interleaved)
    with pytest.raises(RuntimeError, match="another build"):
        ranged.update(spark, root, put(spark, [("a", "first")]), now=DAY)
    assert live(spark, root) == [("a", "1"), ("b", "second")]
    monkeypatch.setattr(ranged, "upsert", real)
    again = ranged.update(spark, root, put(spark, [("a", "first")]), now=DAY)
    assert live(spark, root) == [("a", "first"), ("b", "second")]
    assert len({"20240501", inner[0].version, again.version}) == 3


def test_a_version_name_is_claimed_once(spark, tmp_path):
    root = str(tmp_path)
    assert [build.claim_version(spark, root, "20240501") for _ in range(3)] == ["20240501", "20240501-1", "20240501-2"]
