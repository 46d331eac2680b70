"""Feed documents to the six tables, chunk by chunk."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rinkframe.operators import chunks
from rinkframe.plans import chunk as chunk_plan
from rinkframe.session import Stage
from rinkframe.sinks import runlog, tables as sink
from rinkframe.sources import tables as stored
from rinkframe.sources.zones import Archive, zone_of
from rinkframe.specs import CHUNK_TABLES

log = logging.getLogger(__name__)

_SKIPPED = T.StructType([
    T.StructField("chunk_start", T.DateType()),
    T.StructField("chunk_end", T.DateType()),
    T.StructField("game_id", T.LongType()),
    T.StructField("game_date", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("reason", T.StringType()),
])


@dataclass(frozen=True)
class SyncOptions:
    """Where a sync writes and what it builds."""

    database: str = "default"
    tables: tuple[str, ...] = chunk_plan.ALL_TABLES
    include_preseason: bool = False
    chunk_by: str = "month"
    resume: bool = False
    names: tuple[tuple[str, str], ...] = ()

    def table(self, kind: str) -> str:
        """Full name of a table, run log or skip list."""
        default = CHUNK_TABLES[kind].name if kind in CHUNK_TABLES else kind
        return dict(self.names).get(kind, f"{self.database}.{default}")


def planned_chunks(spark: SparkSession, start: str, end: str, options: SyncOptions) -> DataFrame:
    """Chunks to run, without those already finished if resuming."""
    bounds = spark.createDataFrame([(start, end)], "start string, end string")
    planned = chunks.plan_chunks(bounds, options.chunk_by)
    runs = options.table("_ingest_runs")
    if options.resume and spark.catalog.tableExists(runs):
        planned = chunks.pending_chunks(planned, stored.completed_chunks(spark.table(runs)))
    return planned


def sync(
    spark: SparkSession, landing: str | Archive, start: str, end: str, options: SyncOptions = SyncOptions()
) -> list[dict[str, int]]:
    """Build the tables of every chunk of ``[start, end]``; rows written per chunk.

    ``landing`` is the folder of a landing zone or an archive of documents.
    A failed chunk, one with a day that did not land included, is logged and raises;
    with ``resume`` the next sync takes it up again. The driver holds the list of chunks
    only; all games of a chunk are one set of jobs.
    """
    runlog.create_if_missing(spark, options.table("_ingest_runs"))
    # Calendar parts of a date range: at most one row per month.
    todo = planned_chunks(spark, start, end, options).orderBy("chunk_start").collect()
    return [sync_chunk(spark, landing, c.chunk_start, c.chunk_end, options) for c in todo]


def sync_chunk(
    spark: SparkSession, landing: str | Archive, start: date, end: date, options: SyncOptions
) -> dict[str, int]:
    runs = options.table("_ingest_runs")
    try:
        rows = _write_chunk(spark, landing, start, end, options)
    except Exception as error:
        runlog.record(spark, runs, (start, end), options.chunk_by, "failed", error=str(error))
        raise
    status = "success" if sum(rows.values()) else "empty"
    runlog.record(
        spark, runs, (start, end), options.chunk_by, status, rows if status == "success" else None)
    return rows


def _write_chunk(spark, landing, start, end, options) -> dict[str, int]:
    with Stage(spark) as stage:
        docs = {
            feed: stage.keep(zone_of(spark, landing).days(feed, str(start), str(end)), feed)
            for feed in chunk_plan.needed_feeds(options.tables)
        }
        fatal = chunk_plan.fatal_documents(docs, options.tables).take(1)
        if fatal:
            raise ValueError("{feed} document {request_key}: {reason}".format(**fatal[0].asDict()))
        # At most one row per feed and day of the chunk.
        missing = chunk_plan.missing_days(docs, str(start), str(end)).orderBy("feed", "day").collect()
        if missing:
            named = ", ".join(f"{m.feed} {m.day}" for m in missing)
            raise ValueError(f"documents of these days did not land: {named}")
        plan = chunk_plan.plan_chunk(
            docs, options.tables, options.include_preseason, keep=stage.keep)
        _log_skipped(plan, start, end, options)
        rows = {name: 0 for name in CHUNK_TABLES}
        for name in CHUNK_TABLES:
            if name in plan.names:
                spec, table = CHUNK_TABLES[name], options.table(name)
                sink.create_if_missing(spark, table, spec)
                rows[name] = sink.replace_window(
                    plan.table(name), table, spec, str(start), str(end)).rows
        return rows


def complete_games(
    spark: SparkSession, landing: str | Archive, games: DataFrame, options: SyncOptions
) -> dict[str, int]:
    """Build some games from their documents and swap their rows into the tables.

    ``games`` (``game_id, feed_date``) all of whose documents have landed; the driver
    names their files, so a call is for some thousands of games. Other games of the same
    days are left as they are, and only the partitions of the games' days are rewritten.
    Returns the rows per table.
    """
    with Stage(spark) as stage:
        games = stage.keep(games.select("game_id", "feed_date").distinct(), "games")
        asked = [(str(r.feed_date), str(r.game_id)) for r in games.collect()]
        days = sorted({day for day, _ in asked})
        docs = {
            feed: stage.keep(zone_of(spark, landing).named(
                feed, [(d, d) for d in days] if feed == "score" else asked), feed)
            for feed in chunk_plan.needed_feeds(options.tables) if feed != "standings"
        }
        plan = chunk_plan.plan_chunk(
            docs, options.tables, options.include_preseason, keep=stage.keep, only=games)
        _log_skipped(plan, date.fromisoformat(days[0]), date.fromisoformat(days[-1]), options)
        touched = set(days) | {r.game_date for r in plan.work_list.select("game_date").distinct().collect()}
        rows = {}
        for name in CHUNK_TABLES:
            if name in plan.names and name != "standings":
                spec, table = CHUNK_TABLES[name], options.table(name)
                sink.create_if_missing(spark, table, spec)
                new = plan.table(name)
                if name == "games":
                    new = new.join(games, "game_id", "left_semi")
                rows[name] = sink.replace_games(new, table, spec, games, touched)
        return rows


def _log_skipped(plan, start, end, options) -> None:
    """Keep the skipped games of each attempt in a table of their own."""
    spark, table = plan.status.sparkSession, options.table("_ingest_skipped")
    skipped = plan.skipped.select(
        F.lit(start).alias("chunk_start"), F.lit(end).alias("chunk_end"), "game_id", "game_date",
        "stage", "reason")
    if not spark.catalog.tableExists(table):
        spark.createDataFrame([], _SKIPPED).write.format("parquet").saveAsTable(table)
    sink.append(skipped, table)
