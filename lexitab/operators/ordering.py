"""Stable order, first-wins distinct, exact limits and prefix sums over a total order.

``ord`` is any orderable column that is unique inside its input and gives the input position.
Spark's sort is not stable, so every order here ends in ``ord``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexitab.functions.text import fold
from lexitab.operators.columns import packed, unused
from lexitab.operators.sizing import parts_for
from lexitab.session import materialise

# Fixed value: monotonically_increasing_id() keeps the row number in its low 33 bits.
ROW_BITS = 33


def with_key(df: DataFrame) -> DataFrame:
    return df.withColumn("k", fold("title"))


def range_sort(df: DataFrame, keys: list, num_parts: int | None = None) -> DataFrame:
    """Total order by range partitions; ending ``keys`` in a unique column lets Spark's
    sampled bounds cut through the rows of one hot key.  The number of partitions follows the
    size of what is sorted, unless it is given."""
    num_parts = num_parts or parts_for(df)
    df = df.repartitionByRange(num_parts, *keys) if num_parts else df.repartitionByRange(*keys)
    return df.sortWithinPartitions(*keys)


def number_rows(df: DataFrame) -> DataFrame:
    """Add ``pid`` and ``row`` (position in the partition) to range-sorted rows.

    The pair is only meaningful once the result is written: range bounds come from a sample, so
    a second evaluation may cut elsewhere.
    """
    return (df.withColumn("pid", F.spark_partition_id())
              .withColumn("row", F.monotonically_increasing_id().bitwiseAND((1 << ROW_BITS) - 1)))


def bases(totals: DataFrame, keys: list[str], total: str, base: str = "base",
          within: list[str] | None = None) -> DataFrame:
    """Exclusive prefix sum over a table of per-block totals (one row per partition or block)."""
    order = Window.partitionBy(*(within or [])).orderBy(*keys)
    before = F.sum(total).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return totals.select(*(within or []), *keys, F.coalesce(before, F.lit(0)).cast("long").alias(base))


def with_positions(numbered: DataFrame) -> DataFrame:
    """Zero-based position ``pos`` in the total order, from a written ``number_rows`` table.

    Only one count per partition goes through the one-task window and the broadcast.
    """
    counts = numbered.groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
    return (numbered.join(F.broadcast(bases(counts, ["pid"], "n")), "pid")
            .withColumn("pos", F.col("base") + F.col("row")).drop("base"))


def stable_sort(df: DataFrame, num_parts: int | None = None) -> DataFrame:
    """Stable case-insensitive order of ``(title, value, ord)`` rows."""
    return range_sort(with_key(df), ["k", "ord"], num_parts)


def sorted_table(df: DataFrame, num_parts: int | None = None) -> DataFrame:
    """The stable order as a written table with global positions."""
    return with_positions(materialise(number_rows(stable_sort(df, num_parts)), "sorted"))


def distinct_first(df: DataFrame, order: str | Column = "ord") -> DataFrame:
    """Keep the first row of every exact title.

    ``row_number() = 1`` lets Spark drop later copies before the shuffle, so a title that holds
    a third of all rows sends at most one row per map task.
    """
    rank, name = F.row_number().over(Window.partitionBy("title").orderBy(order)), unused(df, "_rank")
    return df.withColumn(name, rank).filter(F.col(name) == 1).drop(name)


def first_n(df: DataFrame, n: int, order: str = "ord", num_parts: int | None = None) -> DataFrame:
    """The ``n`` rows with the smallest ``order`` (a unique column), for any ``n``.

    ``orderBy().limit(n)`` would pass all ``n`` rows through one task.  Here the rows are
    range-sorted and written once, and the limit is a filter on their position; pass slim rows.
    """
    rows = df.select(packed(df), F.col(order).alias("by"))
    table = materialise(number_rows(range_sort(rows, ["by"], num_parts)), "limit")
    return with_positions(table).filter(F.col("pos") < n).select("data.*")
