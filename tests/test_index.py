import csv
import glob
import io
import json
import random
import re

import pytest

import models
from lexitab.operators import index, lookup, ordering
from lexitab.session import materialise, scratch_path
from lexitab.sinks import files
from lexitab.sinks.files import write_csv_parts
from lexitab.sources.files import read_dictionary, read_lines
from lexitab.sources.records import read_split_dictionary

PAIRS = [("b,c", "x\ny"), ('a"b', ""), (" a", '"q"'), ("", "empty title"), ("é", "日本, 😀"), ("É", "two\r\nlines"),
         ("Zebra", "last"), ("dup", "1"), ("dup", "2"), ("DUP", "3")]


def table(df, parts=4):
    return index.data_table(ordering.stable_sort(df, parts), lambda d: materialise(d, "test"))


def part_bytes(path):
    return b"".join(open(f, "rb").read() for f in sorted(glob.glob(f"{path}/part_file=*/*.txt")))


@pytest.mark.parametrize("parts, part_rows", [(1, 100), (4, 3), (8, 1)])
def test_parts_and_offsets_equal_one_csv_file(spark, rows, parts, part_rows):
    rng = random.Random(3)
    pairs = [rng.choice(PAIRS) for _ in range(60)]
    data = table(rows(pairs), parts)
    path = scratch_path(spark, "csv")
    write_csv_parts(data, path, part_rows)
    want, places = models.csv_bytes(models.stable_sorted(pairs))
    assert b"title,value\r\n" + part_bytes(path) == want
    got = index.build_index(data, "value", part_rows=part_rows).orderBy("byte_offset").collect()
    assert [(r.title, r.value) for r in got] == models.stable_sorted(pairs)
    assert [(r.byte_offset, r.byte_length) for r in got] == places
    assert [r.title for r in got] == [t for t, _ in models.stable_sorted(pairs)]


def test_slices_decode_to_their_rows(spark, rows):
    data = table(rows(PAIRS))
    path = scratch_path(spark, "csv")
    write_csv_parts(data, path, 3)
    got = lookup.fetch_slices(spark, index.build_index(data, part_rows=3), path).orderBy("byte_offset").collect()
    assert [(r.slice_title, r.slice_value) for r in got] == models.stable_sorted(PAIRS)
    assert all(r.title == r.slice_title for r in got)


def test_no_content_is_in_an_exchange(spark, rows):
    data = table(rows(PAIRS))
    path = scratch_path(spark, "csv")
    write_csv_parts(data, path, 1)
    got = lookup.fetch_slices(spark, index.build_index(data, part_rows=1).filter("title = 'é'"), path)
    assert [(r.slice_title, r.slice_value) for r in got.collect()] == [("é", "日本, 😀")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Relation [" in line and "content" in line]
    assert scans and plan.index("MapInArrow") < plan.index("RepartitionByExpression") and "content#" not in plan.split("Relation [")[0]


def test_long_values_by_byte_range(spark, rows, monkeypatch):
    """Rows of over 131 KB, parts that their bytes end, and reads shorter than a row."""
    monkeypatch.setattr(index, "PART_BYTES", 300_000)
    monkeypatch.setattr(lookup, "READ_BYTES", 100_000)
    pairs = [(f"t{i:02}", f"{i}," * 70_000) for i in range(12)] + [("short", "x")]
    data = table(rows(pairs), 2)
    path = scratch_path(spark, "csv")
    write_csv_parts(data, path)
    sizes = [len(open(f, "rb").read()) for f in glob.glob(f"{path}/part_file=*/*.txt")]
    assert len(sizes) > 3 and max(sizes) < 300_000 + 250_000
    got = lookup.fetch_slices(spark, index.build_index(data), path).collect()
    assert sorted((r.slice_title, r.slice_value) for r in got) == sorted(pairs)


def test_many_parts_in_two_partitions(spark):
    """One row per part, 250,000 rows: offsets are those of a plain running sum."""
    many = spark.range(0, 250_000, 1, 2).selectExpr("lpad(id, 9, '0') as title", "'v' as value", "id as ord")
    data = index.data_table(ordering.stable_sort(many, 2), lambda d: materialise(d, "many"))
    got = index.build_index(data, part_rows=1)
    wrong = got.filter("byte_offset <> 13 + cast(title as bigint) * 13 or part_offset <> 0")
    assert wrong.count() == 0 and got.select("part_file").distinct().count() == 250_000


def test_last_wins_and_validation(spark, rows):
    data = table(rows(PAIRS))
    entries = index.build_index(data)
    kept = {r.title: r.byte_offset for r in index.last_wins(entries).collect()}
    want = {}
    for r in entries.orderBy("byte_offset").collect():
        want[r.title] = r.byte_offset
    assert kept == want
    assert tuple(index.index_validation(data).first()) == (9, 10, 1)


def test_shards_are_contiguous_and_even(rows):
    pairs = [(f"t{i:03}", "v") for i in range(100)]
    got = index.index_shards(table(rows(pairs), 5), 8).orderBy("shard").collect()
    assert sum(r.entries for r in got) == 100 and {r.entries for r in got} <= {12, 13}
    assert all(a.max_key < b.min_key for a, b in zip(got, got[1:]))


def test_index_json_is_one_object(spark, rows, monkeypatch):
    monkeypatch.setattr(files, "JSON_PART_ENTRIES", 4)
    entries = index.last_wins(index.build_index(table(rows(PAIRS + [("tab\tback\\", "v")]))))
    path = scratch_path(spark, "json")
    files.write_index_json(entries, path)
    want = {r.title: {"offset": r.byte_offset, "length": r.byte_length}
            for r in entries.orderBy("byte_offset").collect()}
    assert len(glob.glob(f"{path}/part_file=*")) > 1
    assert part_bytes(path).decode() == json.dumps(want, ensure_ascii=False, indent=2) + "\n"


def lines_model(data: bytes, header=True):
    """Titles with byte places of every physical line that parses."""
    out, position = [], 0
    for number, line in enumerate(io.BytesIO(data)):
        start, position = position, position + len(line)
        if header and number == 0:
            continue
        try:
            row = next(iter(csv.reader(io.StringIO(line.decode("utf-8")))))
            out.append((row[0], start, len(line)))
        except Exception:
            continue
    return out


LINES = {
    "plain": b'title,value\r\na,1\r\n"b,c","x"\r\nd,2\r\n',
    "no_final_newline": b"title,value\r\na,1\r\nb,2",
    "blank_and_bad": b"title,value\r\na,1\r\n\r\n\xff\xfe,x\r\nb,2\r\n\n",
    "value_with_newline": b'title,value\r\na,"x\ny"\r\nb,2\r\n',
    "duplicates": b"title,value\r\na,1\r\nA,2\r\na,3\r\n",
    "short_and_extra": b"title,value\r\nonly\r\na,b,c,d\r\n,empty\r\n",
    "stray_return": b"title,value\r\na\rb,1\r\nc,2\r\n",
    "mark": b"\xef\xbb\xbftitle,value\r\na,1\r\nb,2\r\n",
    "mark_no_final_newline": b"\xef\xbb\xbftitle,value\r\na,1\r\nb,2",
    "multi_byte": "title,value\r\né,日本\r\n😀,x\r\n".encode(),
    "header_only": b"title,value\r\n",
}


@pytest.mark.parametrize("name", LINES)
def test_index_of_physical_lines(spark, tmp_path, name):
    path = tmp_path / "data.csv"
    path.write_bytes(LINES[name])
    lines = read_lines(spark, str(path))
    got = index.index_lines(lines).orderBy("byte_offset").collect()
    want = lines_model(LINES[name])
    assert [(r.title, r.byte_offset, r.byte_length) for r in got] == want
    counts = index.line_counts(lines).first()
    assert (counts.total_lines, counts.indexed_lines) == (LINES[name].rstrip(b"\n").count(b"\n") + 1
            + (LINES[name].endswith(b"\n\n")), len(want) + 1)


def test_index_of_a_file_read_in_splits(spark, tmp_path):
    path = tmp_path / "data.csv"
    data, places = models.csv_bytes([(f"t{i}", "v" * (i % 50)) for i in range(3000)])
    path.write_bytes(data)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        lines = read_lines(spark, str(path))
        assert lines.select("block_start").distinct().count() > 5
        got = index.index_lines(lines).orderBy("byte_offset").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.byte_offset, r.byte_length) for r in got] == places


def test_read_dictionary_by_name_with_gaps(spark, tmp_path):
    path = tmp_path / "data.csv"
    path.write_bytes(b'title,value\r\n,\r\nz\r\na,b,extra\r\n\r\n"x","p\r\nq"\r\n"q""t",1\r\n')
    got = read_dictionary(spark, str(path)).orderBy("ord").collect()
    assert [(r.title, r.value) for r in got] == [("", ""), ("z", ""), ("a", "b"), ("x", "p\nq"), ('q"t', "1")]
    path.write_bytes(b"value,title,more\r\n1,a,x\r\n")
    got = read_dictionary(spark, str(path)).first()
    assert (got.title, got.value) == ("a", "1")


def test_a_folder_with_two_headers_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title,value,more\nx,1,m\n")
    (tmp_path / "b.csv").write_text("title,value,more\ny,2,m\n")
    got = read_dictionary(spark, str(tmp_path)).collect()
    assert sorted((r.title, r.value) for r in got) == [("x", "1"), ("y", "2")]
    (tmp_path / "c.csv").write_text("value,title,more\n3,z,m\n")
    for multi_line in (True, False):
        with pytest.raises(Exception, match="header"):
            read_dictionary(spark, str(tmp_path), multi_line).collect()


@pytest.mark.parametrize("split", ["100", "4000", "128m"])
def test_quoted_line_ends_in_splits(spark, tmp_path, split):
    """Also with a line end, an escaped quote or a whole record at a split's edge, and two headers."""
    rng = random.Random(6)
    pairs = [(f"t{i},", "".join(rng.choice(['a', '"', "\n", ",", "\r\n", "é"]) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    for name, flip, some in (("a.csv", False, pairs[:200]), ("b.csv", True, pairs[200:])):
        with open(tmp_path / name, "w", newline="") as f:
            writer = csv.writer(f)
            writer.writerows([p[::-1] if flip else p for p in [("title", "value"), *some]])
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        lines = read_lines(spark, str(tmp_path))
        tasks = lines.select("block_start").distinct().count()
        got = read_split_dictionary(spark, str(tmp_path)).orderBy("ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert tasks > (1 if split != "128m" else 0)
    assert [(r.title, r.value) for r in got] == [(t, v.replace("\r\n", "\n")) for t, v in pairs]


def test_text_after_a_closing_quote(spark, tmp_path):
    """Kept as it stands, quotes included: the reader takes such a field for an unquoted one."""
    (tmp_path / "a.csv").write_text('title,value\n"q"r,2\n')
    assert read_dictionary(spark, str(tmp_path)).first().title == '"q"r'


def test_lookup_and_misses(spark, rows):
    asked = spark.createDataFrame([(1, "dup"), (2, "nope"), (3, "dup"), (4, None)], "request_id long, key string")
    entries = spark.createDataFrame([("dup", "2"), ("DUP", "3")], "title string, value string")
    got = {r.request_id: (r.found, r.value) for r in lookup.lookup(asked, entries).collect()}
    assert got == {1: (True, "2"), 2: (False, None), 3: (True, "2"), 4: (False, None)}
    assert {(r.key, r.requests) for r in lookup.misses(asked, entries).collect()} == {("nope", 1), (None, 1)}


def test_prefixes(spark, rows):
    pairs = [("Apple", "1"), ("apple pie", "2"), ("APT", "3"), ("bee", "4"), ("", "5")]
    got = lookup.prefix_search(rows(pairs), "AP", 2).collect()
    assert [r.title for r in got] == ["Apple", "apple pie"]
    ranks = lookup.prefix_index(rows(pairs), 3, 2)
    assert [r.title for r in ranks.filter("prefix = 'ap'").orderBy("rank").collect()] == ["Apple", "apple pie"]
    assert ranks.filter("prefix = ''").count() == 0
    asked = spark.createDataFrame([(1, "B"), (2, "zz")], "request_id long, prefix string")
    done = lookup.complete(asked, ranks).orderBy("request_id").collect()
    assert [(r.request_id, r.title) for r in done] == [(1, "bee"), (2, None)]


def test_prefixes_for_any_k(spark):
    many = spark.range(6_000).selectExpr("concat('a', lpad(id, 5, '0')) as title", "'' as value", "id as ord")
    ranks = lookup.prefix_index(many, 1, 5_000)
    assert [(r.rank, r.title) for r in ranks.orderBy("rank").collect()] == [(i + 1, f"a{i:05}") for i in range(5_000)]
    plan = lookup.prefix_index(many, 1, 5_000)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number()" not in plan and "windowspecdefinition(prefix" not in plan


def test_the_table_is_cut_before_values_move(spark, tmp_path):
    spark.range(100).selectExpr("cast(id as string) title", "'v' value").write.parquet(str(tmp_path / "t"))
    asked = spark.createDataFrame([(1, "5"), (2, "500")], "request_id long, key string")
    got = lookup.lookup(asked, spark.read.parquet(str(tmp_path / "t")))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") > plan.index("LeftOuter")
    assert {(r.request_id, r.found) for r in got.collect()} == {(1, True), (2, False)}


def test_prefix_filter_reaches_the_scan(spark, rows):
    path = scratch_path(spark, "prefix")
    table(rows(PAIRS)).write.parquet(path)
    plan = lookup.prefix_search(spark.read.parquet(path), "du", 5)._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(k,du)" in plan
