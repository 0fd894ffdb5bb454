import random

import pytest
from pyspark.sql import functions as F

import models
from lexitab.operators import merge
from lexitab.plans import fixtures


def merged(existing, changelog, **options):
    got = merge.upsert(existing, changelog, **options).orderBy("k", "side", "ord").collect()
    return [(r.title, r.value) for r in got]


def random_pairs(rng, n, tag):
    return [("".join(rng.choice("aAbB") for _ in range(rng.randint(1, 2))), f"{tag}{i}") for i in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_equals_two_pointer_walk(rows, seed):
    rng = random.Random(seed)
    e, c = random_pairs(rng, rng.randint(30, 80), "e"), random_pairs(rng, rng.randint(20, 60), "c")
    want, counts = models.merge(e, c)
    assert merged(rows(e), rows(c)) == want
    assert merge.merge_stats(rows(e), rows(c)).first().asDict() == counts
    status = {r.status: r["count"] for r in
              merge.upsert(rows(e), rows(c)).groupBy("status").count().collect()}
    assert status.get("updated", 0) == counts["updated_count"]
    assert status.get("added", 0) == counts["added_count"]


@pytest.mark.parametrize("existing, changelog, want", [
    ([("Apple", "e1"), ("apple", "e2")], [("APPLE", "c1")], [("APPLE", "c1"), ("apple", "e2")]),
    ([("Apple", "e1")], [("apple", "c1"), ("APPLE", "c2")], [("apple", "c1"), ("APPLE", "c2")]),
    ([], [("a", "1")], [("a", "1")]),
    ([("a", "1")], [], [("a", "1")]),
    ([("Apple", "old")], [("Apple", "")], [("Apple", "")]),
    ([], [], []),
])
def test_small_cases(rows, existing, changelog, want):
    assert merged(rows(existing), rows(changelog)) == want


def test_applying_again_changes_nothing(rows):
    rng = random.Random(9)
    e, c = random_pairs(rng, 30, "e"), random_pairs(rng, 20, "c")
    once = merged(rows(e), rows(c))
    assert merged(rows(once), rows(c)) == once


@pytest.mark.parametrize("hot_share", [2, 3])
def test_ordered_merge_is_sorted_and_cuts_a_hot_key(spark, rows, hot_share):
    """One key holds a half or a third of the rows, and every other key is repeated."""
    rng = random.Random(1)
    e = [("Hot" if i % hot_share == 0 else f"k{rng.randint(0, 100)}", f"e{i}") for i in range(1500)]
    c = [("hot" if i % hot_share == 0 else f"K{rng.randint(0, 100)}", f"c{i}") for i in range(600)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = merge.upsert(rows(e), rows(c), ordered=True, num_parts=8)
        got = df.withColumn("pid", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [r.pid for r in got] == sorted(r.pid for r in got)
    assert [(r.title, r.value) for r in got] == models.merge(e, c)[0]
    assert len({r.pid for r in got if r.k == "hot"}) > 1


def test_no_window_and_no_single_task_holds_full_rows(rows):
    plan = merge.upsert(rows([("a", "1")]), rows([("a", "2")]), ordered=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan


def test_partition_count_does_not_matter(spark, rows):
    rng = random.Random(5)
    e, c = random_pairs(rng, 60, "e"), random_pairs(rng, 50, "c")
    want = models.merge(e, c)[0]
    for parts in ("1", "3", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        assert merged(rows(e, int(parts)), rows(c, 2)) == want
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_second_changelog_meets_titles_whose_capitals_upper_would_part(rows):
    first = rows([("straße 5", "a"), ("x", "b")])
    second = fixtures.second_changelog(first)
    assert sorted(merged(first, second)) == [("STRAẞE 5", "a [rev3]"), ("X", "b [rev3]")]
