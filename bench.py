"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
import warnings

from lexitab.plans.queries import QUERIES
from lexitab.session import local_session

HEADLINE = (
    "upsert_merge", "upsert_index", "merge_stats", "sorted_dictionary", "build_index", "dedupe_first",
    "index_last_wins", "index_from_lines", "index_slice_audit", "batch_lookup", "index_lookup",
    "lookup_misses", "prefix_index_topk", "prefix_complete", "hot_keys", "normalize_text", "size_report",
    "synth_dictionary", "published_dictionary",
)
ROUNDS = 2


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    warnings.simplefilter("ignore")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    run(QUERIES["upsert_merge"], spark, sf_dir)
    times = {name: round(min(run(QUERIES[name], spark, sf_dir) for _ in range(ROUNDS)), 3) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline queries, total of best of two", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "rows_per_sec": {name: round(documents / t) for name, t in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
