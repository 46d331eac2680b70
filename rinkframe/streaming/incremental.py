"""Sync driven by newly landed score documents.

The checkpoint of the stream remembers which score files were seen, so a run
picks up the days that came since the last one. Each run drains what is there
and ends. A score file landed again under its old name is not seen; run a sync of
its day.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from rinkframe.plans import sync as plan
from rinkframe.sinks import runlog


def touched_ranges(days: list[date]) -> list[tuple[date, date]]:
    """Consecutive days joined to ranges."""
    ranges: list[tuple[date, date]] = []
    for day in sorted(set(days)):
        if ranges and day - ranges[-1][1] == timedelta(days=1):
            ranges[-1] = (ranges[-1][0], day)
        else:
            ranges.append((day, day))
    return ranges


def sync_new(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    options: plan.SyncOptions = plan.SyncOptions(chunk_by="range"),
    max_files: int = 1000,
) -> None:
    """Sync the days whose score documents are new."""
    runlog.create_if_missing(spark, options.table("_ingest_runs"))
    names = (
        spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(f"{landing.rstrip('/')}/score")
        .select(F.regexp_extract("path", r"feed_date=([0-9-]+)/", 1).cast("date").alias("day"))
    )

    def run(batch: DataFrame, _id: int) -> None:
        # One day per score file, and at most max_files files per batch.
        days = [r.day for r in batch.distinct().collect()]
        for start, end in touched_ranges(days):
            plan.sync_chunk(batch.sparkSession, landing, start, end, options)

    query = (
        names.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
