"""Stand-in inputs derived from whole tables: dictionary T, existing E, changelog C, requests R."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexitab.functions.text import capitals, has_text, normalize
from lexitab.session import materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T: one row per document, titled by its first two words."""
    words = F.substring_index("value", " ", 2)
    return (table(spark, sf_dir, "documents")
            .filter(has_text("text"))
            .select(F.col("doc_id").alias("ord"), normalize("text").alias("value"))
            .select(F.when(F.col("ord") % 2 == 0, F.lower(words)).otherwise(words).alias("title"),
                    "value", "ord"))


def dictionary_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T as a written table, for jobs that pass over it more than once: the text is cleaned one
    time, and passes over titles do not read values."""
    return materialise(dictionary(spark, sf_dir), "input")


def title_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T with empty values as a written table, for jobs that need titles only."""
    return materialise(dictionary(spark, sf_dir).withColumn("value", F.lit("")), "titles")


def existing(t: DataFrame) -> DataFrame:
    return t.filter("ord % 4 <> 0")


def changelog(t: DataFrame) -> DataFrame:
    revised = F.when(F.col("ord") % 8 == 1, F.concat("value", F.lit(" [rev2]"))).otherwise(F.col("value"))
    return t.filter("ord % 4 = 0 or ord % 8 = 1").withColumn("value", revised)


def second_changelog(changelog: DataFrame) -> DataFrame:
    """D: every second row of C once more, with a new value and in other case."""
    return changelog.filter("ord % 16 in (0, 1)").select(
        capitals("title").alias("title"), F.concat("value", F.lit(" [rev3]")).alias("value"), "ord")


def requests(t: DataFrame, events: DataFrame) -> DataFrame:
    """R: one lookup per event, for the title of the document its user number points at."""
    asked = events.select(F.col("event_id").alias("request_id"), "ts", F.col("user_id").alias("ord")).join(
        t.select("ord", "title"), "ord", "left")
    miss = F.concat(F.lit("missing-"), F.col("request_id").cast("string"))
    key = F.when(F.col("request_id") % 10 == 0, miss).otherwise(F.coalesce("title", F.lit("missing-user")))
    return asked.select("request_id", "ts", key.alias("key"))
