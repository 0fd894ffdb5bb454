import datetime
import glob
import json
import os
import random

import pytest

import models
from lexitab.operators import lookup
from lexitab.plans import build
from lexitab.sinks.files import write_manifest
from lexitab.sources.files import read_manifest
from lexitab.streaming.changelog import apply_changelogs

DAY = datetime.datetime(2024, 5, 1, 12, 30, 0, 5)
E = [("Apple", "e1"), ("apple", "e2"), ("b,c", "line\nbreak"), ("Zoo", "é")]
C = [("APPLE", "c1"), ("new", 'quo"te'), ("zoo", "")]


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def put_csv(root, name, pairs):
    with open(os.path.join(root, name), "wb") as f:
        f.write(models.csv_bytes(models.stable_sorted(pairs))[0])
    return name


def live(spark, root):
    return [(r.title, r.value) for r in build.live_data(spark, root).orderBy("pid", "row").collect()]


def file_bytes(root, manifest):
    home = os.path.join(root, os.path.dirname(manifest["file_path"]))
    parts = sorted(glob.glob(f"{home}/data.csv/part_file=*/*.txt"))
    return b"".join(open(f, "rb").read() for f in [f"{home}/header.csv", *parts])


def manifest_of(root):
    with open(os.path.join(root, "manifest.json"), encoding="utf-8") as f:
        return json.load(f)


def test_full_then_incremental(spark, root, rows):
    made = build.build(spark, root, source=rows(E), now=DAY, service_name="words")
    manifest = manifest_of(root)
    assert manifest == {
        "service_name": "words", "service_description": "", "service_author": "",
        "file_path": "dict/20240501/data.csv", "index_file_path": "dict/20240501/index.parquet",
        "changelog_file_path": "", "last_updated_at": "2024-05-01T12:30:00.000005", "version": "20240501"}
    assert (made.rows, made.index_entries) == (4, 4)
    assert file_bytes(root, manifest) == models.csv_bytes(models.stable_sorted(E))[0]

    write_manifest(spark, os.path.join(root, "manifest.json"),
                   manifest | {"changelog_file_path": put_csv(root, "changes.csv", C)})
    made = build.build(spark, root, now=DAY + datetime.timedelta(days=7), part_rows=2)
    want, counts = models.merge(E, C)
    manifest = manifest_of(root)
    assert live(spark, root) == want and made.counters == counts
    data, places = models.csv_bytes(want)
    assert file_bytes(root, manifest) == data
    assert made.data_bytes == len(data) - 13
    assert manifest["version"] == "20240508" and manifest["service_name"] == "words"
    assert manifest["changelog_file_path"] == "changes.csv"
    entries = {r.title: (r.byte_offset, r.byte_length) for r in build.live_index(spark, root).collect()}
    assert entries == {t: p for (t, _), p in zip(want, places)}


def test_values_by_byte_range(spark, root, rows):
    build.full_build(spark, root, rows(E), now=DAY, part_rows=1)
    asked = spark.createDataFrame([(1, "b,c"), (2, "Apple"), (3, "b,c"), (4, "none")], "request_id long, key string")
    got = lookup.read_values(spark, asked, build.live_index(spark, root), build.live_csv(spark, root))
    assert {r.request_id: r.value for r in got.collect()} == {1: "line\nbreak", 2: "e1", 3: "line\nbreak", 4: None}


def test_same_day_build_loses_nothing_and_keeps_the_old_version(spark, root, rows):
    build.full_build(spark, root, rows(E), now=DAY)
    before = file_bytes(root, manifest_of(root))
    first = manifest_of(root)
    put_csv(root, "changes.csv", C)
    for n in (1, 2):
        build.incremental_build(spark, root, changelog_path="changes.csv", now=DAY)
        assert manifest_of(root)["version"] == f"20240501-{n}"
        assert live(spark, root) == models.merge(E, C)[0]
    assert file_bytes(root, first) == before


def test_plain_csv_made_elsewhere_is_accepted(spark, root):
    os.makedirs(os.path.join(root, "dict/20200101"))
    path = put_csv(root, "dict/20200101/data.csv", E)
    write_manifest(spark, os.path.join(root, "manifest.json"),
                   {"file_path": path, "changelog_file_path": put_csv(root, "changes.csv", C)})
    build.build(spark, root, now=DAY, csv=False)
    assert live(spark, root) == models.merge(E, C)[0]


def test_required_manifest_fields(spark, root, rows):
    with pytest.raises(ValueError, match="changelog_file_path"):
        build.incremental_build(spark, root)
    with pytest.raises(ValueError, match="file_path"):
        build.incremental_build(spark, root, changelog_path="changes.csv")
    build.full_build(spark, root, rows(E), now=DAY, csv=False)
    with pytest.raises(ValueError, match="changelog_file_path"):
        build.build(spark, root)


def test_failure_leaves_the_live_version(spark, root, rows, monkeypatch):
    build.full_build(spark, root, rows(E), now=DAY, csv=False)
    before = manifest_of(root)
    put_csv(root, "changes.csv", C)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    for step in ("write_index", "_verify"):
        with monkeypatch.context() as patched:
            patched.setattr(build, step, fail)
            with pytest.raises(RuntimeError, match="lost"):
                build.incremental_build(spark, root, changelog_path="changes.csv", now=DAY)
        assert manifest_of(root) == before and live(spark, root) == models.stable_sorted(E)
    build.incremental_build(spark, root, changelog_path="changes.csv", now=DAY)
    assert live(spark, root) == models.merge(E, C)[0]


def test_rollback(spark, root, rows):
    build.full_build(spark, root, rows(E), now=DAY, csv=False)
    put_csv(root, "changes.csv", C)
    build.incremental_build(spark, root, changelog_path="changes.csv", now=DAY, csv=False)
    build.rollback(spark, root, "20240501", now=DAY)
    assert live(spark, root) == models.stable_sorted(E)
    with pytest.raises(ValueError):
        build.rollback(spark, root, "20990101")


def test_the_manifest_names_only_what_was_written(spark, root, rows):
    made = build.full_build(spark, root, rows(E), now=DAY, csv=False)
    assert made.file_path == manifest_of(root)["file_path"] == "dict/20240501/data.parquet"
    assert os.path.exists(os.path.join(root, made.file_path))
    with pytest.raises(ValueError, match="no CSV parts"):
        build.live_csv(spark, root)
    put_csv(root, "changes.csv", C)
    build.incremental_build(spark, root, changelog_path="changes.csv", now=DAY)
    assert manifest_of(root)["file_path"] == "dict/20240501-1/data.csv" and build.live_csv(spark, root)
    build.rollback(spark, root, "20240501", now=DAY)
    assert manifest_of(root)["file_path"] == "dict/20240501/data.parquet" and live(spark, root) == models.stable_sorted(E)


def test_rollback_checks_the_files(spark, root, rows):
    build.full_build(spark, root, rows(E), now=DAY)
    put_csv(root, "changes.csv", C)
    build.incremental_build(spark, root, changelog_path="changes.csv", now=DAY)
    before = manifest_of(root)
    part = glob.glob(f"{root}/dict/20240501/data.csv/part_file=*/*.txt")[0]
    with open(part, "ab") as f:
        f.write(b"more")
    os.remove(f"{os.path.dirname(part)}/.{os.path.basename(part)}.crc")
    with pytest.raises(RuntimeError, match="CSV parts"):
        build.rollback(spark, root, "20240501")
    os.remove(f"{root}/dict/20240501/index.parquet/_SUCCESS")
    with pytest.raises(RuntimeError, match="no complete index"):
        build.rollback(spark, root, "20240501")
    assert manifest_of(root) == before


def test_a_lost_manifest_is_not_a_first_run(spark, root, rows):
    build.full_build(spark, root, rows(E), now=DAY, csv=False)
    os.remove(os.path.join(root, "manifest.json"))
    with pytest.raises(RuntimeError, match="versions but no manifest"):
        build.build(spark, root, source=rows(E), now=DAY)
    build.rollback(spark, root, "20240501", now=DAY)
    assert live(spark, root) == models.stable_sorted(E)


def test_one_put_where_rename_is_not_atomic(spark, root, monkeypatch):
    from lexitab.sinks import files
    monkeypatch.setattr(files, "RENAMING", set())
    path = os.path.join(root, "manifest.json")
    for version in ("1", "2"):
        write_manifest(spark, path, {"version": version})
        assert build.load_manifest(spark, root) == {"version": version}
    assert [n for n in os.listdir(root) if not n.startswith(".")] == ["manifest.json"]


def test_json_index_of_a_version(spark, root, rows):
    made = build.full_build(spark, root, rows(E), now=DAY, index_json=True)
    want = sorted((r.title, r.byte_offset, r.byte_length) for r in build.live_index(spark, root).collect())
    assert sorted(tuple(r) for r in build.live_index_json(spark, root).collect()) == want
    parts = sorted(glob.glob(f"{root}/dict/20240501/index.json/part_file=*/*.txt"))
    data = b"".join(open(f, "rb").read() for f in parts)
    assert made.index_json_bytes == len(data)
    assert json.loads(data) == {t: {"offset": o, "length": n} for t, o, n in want}


def test_index_mismatch_warns_or_raises(spark, root, rows):
    twice = [("a", "1"), ("a", "2")]
    with pytest.warns(UserWarning, match="difference 1"):
        build.full_build(spark, root, rows(twice), now=DAY, csv=False)
    before = manifest_of(root)
    with pytest.raises(RuntimeError, match="mismatch"):
        build.full_build(spark, root, rows(twice), now=DAY, csv=False, strict=True)
    assert manifest_of(root) == before


def test_empty_dictionary(spark, root, rows):
    made = build.full_build(spark, root, rows([]).filter("ord < 0"), now=DAY)
    assert (made.rows, made.data_bytes) == (0, 0)


def test_hot_key_in_a_build(spark, root, rows):
    rng = random.Random(4)
    e = [("Hot" if i % 3 == 0 else f"k{rng.randint(0, 90)}", f"e{i}") for i in range(600)]
    c = [("hOt" if i % 3 == 0 else f"K{rng.randint(0, 90)}", f"c{i}") for i in range(200)]
    put_csv(root, "changes.csv", c)
    with pytest.warns(UserWarning):
        build.full_build(spark, root, rows(e), now=DAY, csv=False, num_parts=6)
        made = build.incremental_build(spark, root, changelog_path="changes.csv", now=DAY,
                                       num_parts=6, part_rows=50)
    want, counts = models.merge(models.stable_sorted(e), c)
    assert live(spark, root) == want and made.counters == counts
    assert file_bytes(root, manifest_of(root)) == models.csv_bytes(want)[0]


def test_manifest_reading(spark, root):
    path = os.path.join(root, "manifest.json")
    assert read_manifest(spark, path).count() == 0 and build.load_manifest(spark, root) == {}
    write_manifest(spark, path, {"version": "20240101", "file_path": "  "})
    assert read_manifest(spark, path).first().version == "20240101"
    with pytest.raises(ValueError, match="unknown"):
        write_manifest(spark, path, {"colour": "red"})
    with open(path, "w") as f:
        f.write("{not json")
    with pytest.raises(Exception):
        build.load_manifest(spark, root)


def test_blank_file_path_means_a_full_build(spark, root, rows):
    write_manifest(spark, os.path.join(root, "manifest.json"), {"file_path": "  "})
    assert build.build(spark, root, source=rows(E), now=DAY, csv=False).version == "20240501"


def test_streamed_changelogs(spark, root, rows):
    build.full_build(spark, root, rows(E), now=DAY, csv=False)
    incoming = os.path.join(root, "incoming")
    os.makedirs(incoming)
    put_csv(incoming, "one.csv", C)
    apply_changelogs(spark, root, incoming, csv=False).awaitTermination()
    want = models.merge(E, C)[0]
    assert live(spark, root) == want
    version = manifest_of(root)["version"]
    apply_changelogs(spark, root, incoming, csv=False).awaitTermination()
    assert manifest_of(root)["version"] == version
    put_csv(incoming, "two.csv", [("Zoo", "again")])
    apply_changelogs(spark, root, incoming, csv=False).awaitTermination()
    assert live(spark, root) == models.merge(want, [("Zoo", "again")])[0]


def test_waiting_changelogs_apply_one_by_one(spark, root, rows):
    """Two files and a folder on the same keys, one of them with its columns the other way round."""
    build.full_build(spark, root, rows([("a", "1"), ("b", "1")]), now=DAY, csv=False)
    incoming = os.path.join(root, "incoming")
    os.makedirs(os.path.join(incoming, "c3.d"))
    put_csv(incoming, "c1.csv", [("a", "2")])
    with open(os.path.join(incoming, "c2.csv"), "w") as f:
        f.write("value,title\n3,a\n3,A\n")
    put_csv(os.path.join(incoming, "c3.d"), "x.csv", [("b", "4")])
    apply_changelogs(spark, root, incoming, csv=False).awaitTermination()
    assert live(spark, root) == [("a", "3"), ("A", "3"), ("b", "4")]
    versions = sorted(os.listdir(os.path.join(root, "dict")))
    assert [v[8:] for v in versions if "-b" in v] == [f"-b000000-00{i}" for i in range(3)]
