"""Apply changelogs as they arrive, one after the other."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexitab.plans.build import incremental_build
from lexitab.sources.files import read_dictionary


def _names(batch: DataFrame, incoming: str) -> list[str]:
    """The changelogs a batch of files belongs to, in the order in which they apply: by name.

    There is one per weekly or daily drop, so the names are few; contents are not read here.
    """
    name = F.regexp_extract("path", "/" + os.path.basename(incoming.rstrip("/")) + r"/+([^/]+)(/[^/]*)*$", 1)
    return sorted(r.name for r in batch.select(name.alias("name")).distinct().collect() if r.name)


def apply_changelogs(spark: SparkSession, root: str, incoming: str, checkpoint: str | None = None,
                     **options):
    """Upsert every new changelog below ``incoming`` into the live version, then stop.

    A changelog is a CSV file, or a folder of them, directly below ``incoming`` and moved there whole;
    columns go by header name.  Each one is an incremental build of its own, in the order of the names,
    so what is published does not depend on how files fall into batches as long as later changelogs have
    later names.  The version's name holds the batch and the changelog's number in it.  A batch that is
    replayed after a failure gives the same rows again: its changelogs apply again in the same order.
    """
    files = (spark.readStream.format("binaryFile").option("pathGlobFilter", "*.csv")
             .option("recursiveFileLookup", "true").schema("path string, modificationTime timestamp, length long, content binary")
             .load(incoming).select("path"))

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        for number, name in enumerate(_names(batch, incoming)):
            changelog = read_dictionary(spark, os.path.join(incoming, name))
            incremental_build(spark, root, changelog, tag=f"b{batch_id:06}-{number:03}", **options)

    return (files.writeStream.foreachBatch(upsert_batch).trigger(availableNow=True)
            .option("checkpointLocation", checkpoint or os.path.join(root, "_changelog_progress"))
            .start())
