import csv
import io
import random

import pytest

from lexitab.operators import lookup
from lexitab.sources import records

HEADER = "title,value\r\n"


def by_reader(text, header=True):
    """Rows by Python's reader, line ends in values as line feeds."""
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    names = rows.pop(0) if header else ["title", "value"]
    at = [names.index(n) if n in names else -1 for n in ("title", "value")]
    return [tuple((r[i] if 0 <= i < len(r) else "").replace("\r\n", "\n") for i in at) for r in rows]


@pytest.fixture
def split_small(spark):
    """Splits of a few hundred bytes."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def read(spark, path, header=True):
    found = records.read_split_dictionary(spark, str(path), header).collect()
    return [(r.title, r.value) for r in sorted(found, key=lambda r: (r.ord.file, r.ord.row))]


def test_lone_quotes_cost_no_row(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes((HEADER + '5" disk,small\nb,2\nc,3\n').encode())
    assert read(spark, tmp_path) == [('5" disk', "small"), ("b", "2"), ("c", "3")]


def test_adversarial_files_in_several_splits(spark, tmp_path, split_small):
    draw = random.Random(21)
    parts = ['"', '""', '"""', ",", "a", "bc ", '5" disk', '"quoted"', '"two\nlines"', '"x"y', "\r\n", "\n", '"",', 'q"q"', "é", " ", '"a ""b"" c\r\n\r\n,d"']
    for number in range(6):
        text = HEADER if number else "﻿" + "value,other,title\n"
        text += "".join(draw.choice(parts) for _ in range(draw.choice([5, 300, 1_500]))) + draw.choice(["", "\n", '"\n'])
        (tmp_path / f"f{number}.csv").write_bytes(text.encode())
    want = []
    for number in range(6):
        want += by_reader((tmp_path / f"f{number}.csv").read_bytes().decode("utf-8-sig"))
    splits = spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions()
    assert splits > 20
    assert read(spark, tmp_path) == want


def test_one_record_over_many_splits(spark, tmp_path, split_small):
    long = "\n".join(f'line "" {i}' for i in range(600))
    (tmp_path / "a.csv").write_bytes((HEADER + f'a,"{long}"\r\nb,2\r\n').encode())
    assert read(spark, tmp_path) == [("a", long.replace('""', '"')), ("b", "2")]


def test_a_quote_that_is_never_closed(spark, tmp_path, split_small):
    text = HEADER + "a,1\n" + 'b,"open\n' + "c,3\n" * 200
    (tmp_path / "a.csv").write_bytes(text.encode())
    assert read(spark, tmp_path) == by_reader(text.removesuffix("\n"))


def test_a_header_that_never_ends_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(('"title,value\n' + "c,3\n" * 40_000).encode())
    with pytest.raises(Exception, match="never closed"):
        read(spark, tmp_path)


@pytest.mark.parametrize("inside", [False, True])
def test_state_after_a_line_is_the_reader_s(inside):
    """Against the automaton, character by character."""
    draw = random.Random(3)
    for _ in range(5_000):
        line = "".join(draw.choice('",ab') for _ in range(draw.randint(0, 12)))
        state = "quoted" if inside else "start"
        for c in line:
            if state == "quoted":
                state = "quote" if c == '"' else "quoted"
            elif c == '"' and state in ("start", "quote"):
                state = "quoted"
            else:
                state = "start" if c == "," else "plain"
        assert records.ends_inside(line, inside) == (state == "quoted"), line


@pytest.mark.parametrize("k", [1, 2, 7, 50, 5_000])
def test_prefix_ranks_by_brute_force(spark, monkeypatch, k):
    """Blocks of any size, copies, case, short titles and prefixes that nearly all titles share."""
    monkeypatch.setattr(lookup, "BLOCK", 16)
    draw = random.Random(k)
    titles = ["".join(draw.choice("aAbé\U0001F600") for _ in range(draw.randint(0, 5))) for _ in range(400)] + ["aaaa"] * 50 + [f"aaa{i:03}" for i in range(200)]
    want = []
    distinct = sorted(set(titles) - {""}, key=lambda t: (t.lower(), t))
    for n in range(1, 5):
        by_prefix = {}
        for t in distinct:
            if len(t.lower()) >= n:
                by_prefix.setdefault(t.lower()[:n], []).append(t)
        want += [(p, i, t) for p, some in by_prefix.items() for i, t in enumerate(some[:k], 1)]
    table = spark.createDataFrame([(t,) for t in titles], "title string").repartition(7)
    assert sorted(map(tuple, lookup.prefix_index(table, 4, k).collect())) == sorted(want)
    assert lookup.prefix_index(spark.createDataFrame([], "title string"), 4, k).count() == 0
