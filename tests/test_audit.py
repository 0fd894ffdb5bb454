"""Digests of a version's files against damage that keeps every size."""

import datetime
import glob
import os

import pytest
from pyspark.sql import Row

from lexitab.plans import build

DAY = datetime.datetime(2024, 5, 1)
ROWS = [(f"word {i:03d}", f"text {i}" + ("\nand more, \"quoted\"\r\n\nend" if i % 7 == 0 else "")) for i in range(200)]
ROWS += [("\ufeffmark", "\ufeff"), ("\ufeff\ufeffmarks", "x"), ("", ""), ("é ż", "null \x00 byte")]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("audit"))
    source = spark.createDataFrame([Row(title=t, value=v, ord=i) for i, (t, v) in enumerate(ROWS)])
    build.full_build(spark, root, source, now=DAY, part_rows=30, index_json=True)
    return root


def verdicts(spark, root):
    return {(r.kind, r.part_file): r.damaged for r in build.audit(spark, root).collect()}


def damage(path, change):
    """Change a file and its checksum goes; gives back what undoes it."""
    with open(path, "rb") as f:
        before = f.read()
    after = change(before)
    assert len(after) == len(before) and after != before
    folder, name = os.path.split(path)
    side = os.path.join(folder, f".{name}.crc")
    with open(side, "rb") as f:
        kept = f.read()
    os.remove(side)
    with open(path, "wb") as f:
        f.write(after)

    def undo():
        with open(path, "wb") as f:
            f.write(before)
        with open(side, "wb") as f:
            f.write(kept)
    return undo


def csv_parts(root):
    return sorted(glob.glob(f"{root}/dict/*/data.csv/part_file=*/*.txt"))


def test_a_sound_version(spark, root):
    found = verdicts(spark, root)
    assert len(csv_parts(root)) > 4 and len(found) == len(csv_parts(root)) + 2
    assert not any(found.values())
    counted = {r.kind: r for r in build.audit(spark, root).groupBy("kind").sum("lines", "bytes").collect()}
    assert counted["index.json"]["sum(lines)"] == counted["index.parquet"]["sum(lines)"] == len(ROWS)
    content = b"".join(open(p, "rb").read() for p in csv_parts(root))
    assert counted["data.csv"]["sum(lines)"] == content.count(b"\n")


def _swap_lines(content):
    """Two lines of one length change places."""
    lines = content.split(b"\n")
    for i in range(len(lines) - 1):
        if len(lines[i]) == len(lines[i + 1]) and lines[i] != lines[i + 1]:
            lines[i], lines[i + 1] = lines[i + 1], lines[i]
            return b"\n".join(lines)
    raise AssertionError("no two such lines")


@pytest.mark.parametrize("change", [
    lambda c: c.replace(b"text", b"Text", 1), lambda c: c[:-1] + b"x", lambda c: c.replace(b"\r\n", b"\n\n", 1), _swap_lines])
def test_a_damaged_part_is_named(spark, root, change):
    path = csv_parts(root)[2]
    undo = damage(path, change)
    try:
        name = path.split("part_file=")[1].split("/")[0]
        assert [k for k, bad in verdicts(spark, root).items() if bad] == [("data.csv", name)]
        with pytest.raises(RuntimeError, match=name):
            build.rollback(spark, root, "20240501")
    finally:
        undo()


def test_small_splits_give_the_same_digests(spark, root):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "100b")
    try:
        assert not any(verdicts(spark, root).values())
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("change", [
    lambda c: c.replace(b"word 010", b"word O10"), lambda c: c.replace(b'"length": 1', b'"length": 2', 1), lambda c: b"[" + c[1:]])
def test_a_damaged_json_index(spark, root, change):
    undo = damage(sorted(glob.glob(f"{root}/dict/*/index.json/part_file=*/*.txt"))[0], change)
    try:
        assert [k for k, bad in verdicts(spark, root).items() if bad] == [("index.json", "index.json")]
    finally:
        undo()


def test_a_version_without_digests_and_an_empty_one(spark, tmp_path):
    with pytest.raises(ValueError, match="no digests"):
        build.audit(spark, str(tmp_path), "20200101")
    build.full_build(spark, str(tmp_path), spark.createDataFrame([], "title string, value string, ord long"), now=DAY)
    assert verdicts(spark, str(tmp_path)) == {("index.parquet", "index.parquet"): False}
