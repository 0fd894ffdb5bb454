"""Upsert of a changelog into a dictionary, with pairwise semantics per folded key.

Inside one folded key the i-th existing row pairs with the i-th changelog row.  A pair gives the
changelog row; unpaired rows of either side stay.  So with ``p`` pairs in a key, its first ``p``
existing rows go and its first ``p`` changelog rows are updates: two cutoffs decide every row.  The
output order is ``(k, side, ord)``, changelog rows first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexitab.operators.ordering import number_rows, range_sort, with_key, with_positions
from lexitab.session import materialise

# Changelog rows sort first; sums over ``side`` count existing rows.
CHANGELOG, EXISTING = 0, 1
KEPT, UPDATED, ADDED = "kept", "updated", "added"


def _tagged(existing: DataFrame, changelog: DataFrame, *columns: str) -> DataFrame:
    sides = [with_key(df).select(*columns, "k", F.lit(side).alias("side"))
             for df, side in ((changelog, CHANGELOG), (existing, EXISTING))]
    return sides[0].unionByName(sides[1])


def _side_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("k").agg(F.count_if(F.col("side") == CHANGELOG).alias("n_c"),
                                 F.count_if(F.col("side") == EXISTING).alias("n_e"))


def cutoffs(existing: DataFrame, changelog: DataFrame) -> DataFrame:
    """For each key that has pairs the last paired ``ord`` of either side: ``(k, cut_c, cut_e)``.

    Only ``(k, side, ord)`` of the changelog's keys moves.  A range sort numbers the rows and may cut
    anywhere inside a key, so a key of any size is spread; ``groups`` has one row per key and side.
    """
    slim = _tagged(existing, changelog, "ord")
    keys = with_key(changelog).select("k").distinct()
    slim = slim.join(keys, "k", "left_semi")
    ranked = with_positions(materialise(number_rows(range_sort(slim, ["k", "side", "ord"])), "ranked"))
    groups = ranked.groupBy("k", "side").agg(F.min("pos").alias("start"), F.count(F.lit(1)).alias("n"))
    pairs = groups.groupBy("k").agg(F.count(F.lit(1)).alias("sides"), F.min("n").alias("pairs")).filter("sides = 2")
    last = groups.join(pairs, "k").select("k", "side", (F.col("start") + F.col("pairs") - 1).alias("pos"))
    # Positions are unique, so this join has no hot key.
    cut = ranked.select("pos", "ord").join(last, "pos")
    return cut.groupBy("k").agg(F.max(F.when(F.col("side") == CHANGELOG, F.col("ord"))).alias("cut_c"),
                                F.max(F.when(F.col("side") == EXISTING, F.col("ord"))).alias("cut_e"))


def upsert(existing: DataFrame, changelog: DataFrame, *carried: str, ordered: bool = False,
           num_parts: int | None = None) -> DataFrame:
    """Merge ``(title, value, ord)`` tables into ``(title, value, k, side, ord, status)``.

    Columns named in ``carried``, which both tables have, come along.

    Full rows meet the cutoffs in a left join, which are unique per key: Spark broadcasts them if they
    are small, else it can split a hot key, which is on one side only.  ``ordered=True`` adds a range
    exchange on ``(k, side, ord)``, whose bounds may cut inside a key too.
    """
    cuts = materialise(cutoffs(existing, changelog), "cutoffs")
    rows = _tagged(existing, changelog, "title", "value", "ord", *carried).join(cuts, "k", "left")
    from_changelog = F.col("side") == CHANGELOG
    updated = F.coalesce(F.col("ord") <= F.col("cut_c"), F.lit(False))
    replaced = F.coalesce(F.col("ord") <= F.col("cut_e"), F.lit(False))
    status = F.when(~from_changelog, KEPT).when(updated, UPDATED).otherwise(ADDED)
    merged = (rows.filter(from_changelog | ~replaced).withColumn("status", status)
              .select("title", "value", "k", "side", "ord", "status", *carried))
    return range_sort(merged, ["k", "side", "ord"], num_parts) if ordered else merged


def merge_stats(existing: DataFrame, changelog: DataFrame) -> DataFrame:
    """The five merge counters.  They follow from the two row counts of every key, so nothing
    is merged: one slim aggregate, combined before its shuffle."""
    counts = _side_counts(_tagged(existing, changelog))
    totals = {
        "existing_count": F.col("n_e"),
        "changelog_count": F.col("n_c"),
        "updated_count": F.least("n_c", "n_e"),
        "added_count": F.col("n_c") - F.least("n_c", "n_e"),
        "total_count": F.greatest("n_c", "n_e"),
    }
    return counts.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(name) for name, n in totals.items()))


def added_rows(merged: DataFrame) -> DataFrame:
    return merged.filter(F.col("status") == ADDED)


def updated_rows(merged: DataFrame) -> DataFrame:
    return merged.filter(F.col("status") == UPDATED)


def untouched_rows(merged: DataFrame) -> DataFrame:
    return merged.filter(F.col("status") == KEPT)
