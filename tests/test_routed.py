import random

import pytest
from pyspark.sql import functions as F

from lexitab.operators import routed


@pytest.fixture
def index(spark, tmp_path):
    """12,000 even numbers as titles, in 8 shards of small row groups."""
    path = str(tmp_path / "index")
    entries = spark.range(12_000).select(F.format_string("k%07d", F.col("id") * 2).alias("title"), F.col("id").alias("byte_offset"))
    routed.write_routed(entries, path, 8, **{"parquet.block.size": "20000", "parquet.page.size": "4000"})
    return path


def scanned(df):
    """Files and rows that the scan of the entries read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = (plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.nodeName() else plan).collectLeaves()
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        if metrics.contains("numFiles"):
            return metrics.apply("numFiles").value(), metrics.apply("numOutputRows").value()
    raise AssertionError("no scan")


def test_bloom_filters_skip_row_groups(spark, index):
    hit = routed.find(spark, index, ["k0000100"])
    files, rows = scanned(hit)
    assert [r.title for r in hit.collect()] == ["k0000100"]
    assert files == 1 and 0 < rows < 1_500
    # Odd numbers lie between the titles of a row group, so only its Bloom filter can tell that they are missing.
    read = [scanned(routed.find(spark, index, [f"k{i:07}"]))[1] for i in range(101, 2_101, 100)]
    assert sum(n == 0 for n in read) >= 18
    assert routed.find(spark, index, []).count() == 0
    with pytest.raises(ValueError):
        routed.find(spark, index, ["x"] * 201)


def test_requests_open_their_shards_only(spark, index):
    asked = [(1, "k0000100"), (2, "k0000101"), (3, None), (4, "k0000100"), (5, "a"), (6, "k0000102")]
    requests = spark.createDataFrame(asked, "request_id int, key string")
    found = routed.routed_lookup(requests, index)
    assert {r.request_id: (r.found, r.byte_offset) for r in found.collect()} == {
        1: (True, 50), 2: (False, None), 3: (False, None), 4: (True, 50), 5: (False, None), 6: (True, 51)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan and "(shard#" in plan and " = 0)" in plan


def test_any_titles(spark, tmp_path):
    draw = random.Random(2)
    titles = sorted({"".join(draw.choice("aAbé日\U0001F600 ") for _ in range(draw.randint(0, 4))) for _ in range(300)})
    path = str(tmp_path / "index")
    routed.write_routed(spark.createDataFrame([(t, i) for i, t in enumerate(titles)], "title string, byte_offset int"), path, 7)
    keys = titles[::2] + ["zz", "", "\U0010ffff", "aab"]
    requests = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "request_id int, key string")
    got = {r.request_id: r.byte_offset for r in routed.routed_lookup(requests, path).collect()}
    assert got == {i: titles.index(k) if k in titles else None for i, k in enumerate(keys)}


def test_an_empty_index(spark, tmp_path):
    path = str(tmp_path / "index")
    routed.write_routed(spark.createDataFrame([], "title string, byte_offset int"), path)
    requests = spark.createDataFrame([(1, "a")], "request_id int, key string")
    assert [r.found for r in routed.routed_lookup(requests, path).collect()] == [False]
