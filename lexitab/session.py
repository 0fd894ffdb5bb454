"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", app: str = "lexitab", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share for tables that cut lineage.

    It is the session's ``spark.checkpoint.dir``.  A temporary folder stands in only on a
    local master, where driver and executors are one process.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lexitab-"))
    return scratch_root(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared scratch folder."""
    return os.path.join(scratch_root(spark), "lexitab", f"{label}-{uuid.uuid4().hex}")


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a new zstd Parquet table and read it back."""
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage with a written table: later jobs see one fixed set of rows and partitions,
    also when executors are lost, and read only the columns they need."""
    return write_table(df, scratch_path(df.sparkSession, label))
