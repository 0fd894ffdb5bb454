"""File names and sizes from a listing; no content is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def listed_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """``(file_path, file_size)`` of the files below ``path``, named as a reader's metadata names them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(F.col("_metadata.file_path").alias("file_path"), F.col("length").alias("file_size"))


def listed_bytes(spark: SparkSession, path: str, pattern: str) -> int:
    return listed_files(spark, path, pattern).agg(F.coalesce(F.sum("file_size"), F.lit(0))).first()[0]
