"""Partition counts from the bytes a plan reads."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

# What Spark reports for a table whose size it does not know.
UNKNOWN = (1 << 63) - 1
# Stored bytes for one shuffle partition; compressed columns grow severalfold in memory.
PART_BYTES = 64 * 1024 ** 2


def _row_width(node) -> int:
    output = node.output()
    return 8 + sum(output.apply(i).dataType().defaultSize() for i in range(output.size()))


def moved_bytes(df: DataFrame) -> int:
    """About how many stored bytes an exchange of ``df`` moves: the size of every table below it, from
    file listings, by the share of its row width that ``df`` still has.

    Joins and filters do not count, and neither do tables of unknown size.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    width, total = _row_width(plan), 0
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        size = int(str(leaf.stats().sizeInBytes()))
        if size < UNKNOWN:
            total += math.ceil(size * min(1.0, width / _row_width(leaf)))
    return total


def parts_for(df: DataFrame, part_bytes: int = PART_BYTES) -> int | None:
    """How many partitions an exchange of ``df`` needs, one for each ``part_bytes``; ``None`` if the
    session's own number, which Spark may lower, is enough."""
    needed = math.ceil(moved_bytes(df) / part_bytes)
    return needed if needed > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None
