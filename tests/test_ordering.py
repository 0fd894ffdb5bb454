import random

from pyspark.sql import functions as F

import models
from lexitab.operators import ordering, sizing


def test_sort_is_stable_and_positions_count_up(rows):
    rng = random.Random(2)
    pairs = [(rng.choice(["Zebra", "zebra", "apple", "Éa", "éb", "", "a,b"]), str(i)) for i in range(300)]
    got = ordering.sorted_table(rows(pairs), 5).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(300))
    assert [(r.title, r.value) for r in got] == models.stable_sorted(pairs)


def test_distinct_first_is_case_sensitive(rows):
    pairs = [("b", "1"), ("a", "2"), ("B", "3"), ("b", "4"), ("a", "5")]
    got = ordering.distinct_first(rows(pairs)).orderBy("ord").collect()
    assert [(r.title, r.value) for r in got] == [("b", "1"), ("a", "2"), ("B", "3")]


def test_distinct_first_combines_before_the_shuffle(rows):
    plan = ordering.distinct_first(rows([("a", "1")]))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_first_n(spark):
    ids = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 1009).alias("ord"))
    want = sorted(i * 37 % 1009 for i in range(1000))
    for n in (0, 1, 400, 1000, 5000):
        assert sorted(r.ord for r in ordering.first_n(ids, n).collect()) == want[:n]


def test_partition_counts_follow_the_size(spark, tmp_path, monkeypatch):
    """The session's own number of shuffle partitions stays as it is."""
    sizes = []
    for n in (1_000, 8_000):
        path = str(tmp_path / str(n))
        spark.range(n).selectExpr("id as ord", "sha2(cast(id as string), 512) as value").write.parquet(path)
        sizes.append(sizing.moved_bytes(spark.read.parquet(path)))
    assert 7 < sizes[1] / sizes[0] < 9
    table = spark.read.parquet(path)
    assert sizing.parts_for(table) is None
    monkeypatch.setattr(sizing.parts_for, "__defaults__", (sizes[1] // 40,))
    assert 40 <= sizing.parts_for(table) <= 42
    assert sizing.parts_for(table.select("ord")) < 40
    assert ordering.range_sort(table, ["ord"]).rdd.getNumPartitions() >= 40
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert sizing.moved_bytes(spark.createDataFrame([(1,)], "a int")) == 0


def test_helper_columns_meet_no_column_of_the_input(spark):
    rows = spark.createDataFrame([("a", 1, 7, 8, 9, "x", "y"), ("a", 2, 7, 8, 9, "x", "y"), ("b", 3, 5, 6, 4, "z", "w")],
                                 "title string, ord int, _rank int, pid int, pos int, data string, by string")
    first = sorted(map(tuple, ordering.distinct_first(rows).collect()))
    assert first == [("a", 1, 7, 8, 9, "x", "y"), ("b", 3, 5, 6, 4, "z", "w")]
    limited = ordering.first_n(rows, 2)
    assert limited.columns == rows.columns and sorted(map(tuple, limited.collect())) == [("a", 1, 7, 8, 9, "x", "y"), ("a", 2, 7, 8, 9, "x", "y")]
