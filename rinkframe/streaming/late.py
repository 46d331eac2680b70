"""Games whose documents land in any order and at any time.

A stream over the landing zone keeps, for every game and day, which feeds have landed. A
day is synced once its own documents are there, with the games that are whole by then. A
game that gets its last document later is completed then: its documents are read by name
and its rows swapped into the tables, without a sync of the day. A listed game that is
not whole after a time of grace is reported, and still completed if the rest comes.

The state is one number a game, dropped when the game is whole; documents stay in the
landing zone. Documents of games that no score document lists stay open. A game listed on
two days is one game per day, as in two chunks. A document landed again under its old
name is not seen; run a sync of its day.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rinkframe.operators import flatten
from rinkframe.plans import chunk as chunk_plan, sync as plan
from rinkframe.sinks import runlog, tables as sink
from rinkframe.sources import feeds
from rinkframe.specs import CHUNK_TABLES
from rinkframe.streaming.incremental import touched_ranges

# A feed's place is its bit in the state.
FEEDS = ("score", "standings", *feeds.GAME_FEEDS)
# Stands for the day itself among its games.
THE_DAY = 0
EVENTS = "game_id BIGINT, feed_date DATE, kind STRING, missing STRING"
_STATE = "seen INT"
_FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def bits(names) -> int:
    return sum(1 << FEEDS.index(n) for n in names)


def missing(seen: int, needed: int) -> str:
    return ",".join(n for k, n in enumerate(FEEDS) if needed & ~seen & 1 << k)


class OpenGames(StatefulProcessor):
    """Feeds seen per game and day; emits ``complete`` and ``overdue``."""

    def __init__(self, day_needs: int, game_needs: int, grace: timedelta):
        self.day_needs, self.game_needs = day_needs, game_needs
        self.grace = int(grace.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", _STATE)

    def needs(self, key) -> int:
        return self.day_needs if key[0] == THE_DAY else self.game_needs

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.state.get()[0] if self.state.exists() else 0
        seen, needed = before, self.needs(key)
        for row in rows:
            seen |= 1 << row["bit"]
        if needed & ~seen == 0:
            self.state.clear()
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            yield Row(game_id=key[0], feed_date=key[1], kind="complete", missing="")
            return
        self.state.update((seen,))
        listed = bits(["score"])
        if seen & listed and not before & listed:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.grace)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.state.exists():
            left = missing(self.state.get()[0], self.needs(key))
            yield Row(game_id=key[0], feed_date=key[1], kind="overdue", missing=left)

    def close(self) -> None:
        pass


def landed(spark: SparkSession, landing: str, options: plan.SyncOptions, max_files: int) -> DataFrame:
    """Stream of what landed: ``game_id, feed_date, bit``.

    Contents are read of score documents only; of the others the name says all.
    """
    root = landing.rstrip("/")
    needed = chunk_plan.needed_feeds(options.tables)

    def files(names) -> DataFrame:
        reader = spark.readStream.format("binaryFile").schema(_FILES)
        reader = reader.option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", max_files)
        return reader.load(f"{root}/{{{','.join(names)}}}/feed_date=*").select(
            "content", F.regexp_extract("path", r"/feed_date=([0-9-]+)/", 1).cast("date").alias("feed_date"),
            F.regexp_extract("path", r"/([a-z_]+)/feed_date=", 1).alias("feed"),
            F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("request_key"))

    def rows(df: DataFrame, game, feed) -> DataFrame:
        place = F.array_position(F.array(*(F.lit(f) for f in FEEDS)), feed) - 1
        return df.select(game.cast("bigint").alias("game_id"), "feed_date", place.cast("int").alias("bit"))

    score = files(["score"])
    days = rows(score, F.lit(THE_DAY), F.lit("score"))
    texts = score.withColumn("payload", F.col("content").cast("string"))
    listed = flatten.score_games(feeds.parse_documents(texts, "score"))
    if not options.include_preseason:
        listed = listed.where(F.coalesce(F.col("game.gameType"), F.lit(0)) != 1)
    games = rows(listed.where("game.id IS NOT NULL"), F.col("game.id"), F.lit("score"))
    others = files([f for f in needed if f != "score"])
    named = F.when(F.col("feed") == "standings", F.lit(THE_DAY)).otherwise(F.col("request_key").try_cast("bigint"))
    rest = rows(others.where(named.isNotNull()), named, F.col("feed"))
    return days.unionByName(games).unionByName(rest)


def follow(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    options: plan.SyncOptions = plan.SyncOptions(chunk_by="range"),
    grace: timedelta = timedelta(days=1),
    max_files: int = 1000,
) -> None:
    """Take up all that landed since the last call, then end.

    The state lives in ``checkpoint`` (RocksDB). What became of games that came late is
    appended to the table ``_ingest_late``: ``complete`` with the day's sync behind it, or
    ``overdue`` with the feeds it waits for. Grace ends with the first documents after it.
    """
    runlog.create_if_missing(spark, options.table("_ingest_runs"))
    needed = set(chunk_plan.needed_feeds(options.tables))
    processor = OpenGames(
        bits(needed.intersection(feeds.DATE_FEEDS)), bits(needed.difference(["standings"])), grace)
    events = landed(spark, landing, options, max_files).groupBy("game_id", "feed_date").transformWithState(
        processor, EVENTS, "append", "processingTime")

    settings = {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # Timers alone start no batch; else a run that drains the landing zone never ends.
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        query = (
            events.writeStream.foreachBatch(lambda batch, _id: take(batch, landing, options))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    # Batches write in a session of their own; this one must list the tables anew.
    for kind in (*CHUNK_TABLES, "_ingest_runs", "_ingest_skipped", "_ingest_late"):
        if spark.catalog.tableExists(options.table(kind)):
            spark.catalog.refreshTable(options.table(kind))


def take(batch: DataFrame, landing: str, options: plan.SyncOptions) -> None:
    """Sync the days that became ready, complete the games that became whole."""
    spark = batch.sparkSession
    # At most one row per file and listed game of the batch.
    rows = batch.collect()
    days = {r.feed_date for r in rows if r.game_id == THE_DAY and r.kind == "complete"}
    for start, end in touched_ranges(list(days)):
        try:
            plan.sync_chunk(spark, landing, start, end, options)
        except ValueError:  # a bad document of the day; the run log has it
            continue
    games = [r for r in rows if r.game_id != THE_DAY and not (r.kind == "complete" and r.feed_date in days)]
    if not games:
        return
    whole = [(r.game_id, r.feed_date) for r in games if r.kind == "complete"]
    if whole:
        plan.complete_games(spark, landing, spark.createDataFrame(whole, "game_id BIGINT, feed_date DATE"), options)
    log = options.table("_ingest_late")
    told = spark.createDataFrame(games, EVENTS).withColumn("told_at", F.current_timestamp())
    if not spark.catalog.tableExists(log):
        told.limit(0).write.format("parquet").saveAsTable(log)
    sink.append(told, log)


def open_games(spark: SparkSession, checkpoint: str, tables: tuple[str, ...] = chunk_plan.ALL_TABLES) -> DataFrame:
    """Games and days that wait for documents: ``game_id, feed_date, missing``.

    Read from the stream's state; game 0 is a day that waits for its own documents.
    """
    needed = set(chunk_plan.needed_feeds(tables))
    state = (spark.read.format("statestore").option("path", checkpoint)
             .option("stateVarName", "open").load())
    day, game = (F.lit(bits(n)) for n in (
        needed.intersection(feeds.DATE_FEEDS), needed.difference(["standings"])))
    wants = F.when(F.col("key.game_id") == THE_DAY, day).otherwise(game)
    left = wants.bitwiseAND(F.bitwise_not(F.col("value.seen")))
    names = F.filter(F.array(*(F.when(left.bitwiseAND(F.lit(1 << k)) != 0, F.lit(n))
                               for k, n in enumerate(FEEDS))), lambda x: x.isNotNull())
    return state.select("key.game_id", "key.feed_date", F.array_join(names, ",").alias("missing"))
