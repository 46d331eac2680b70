"""Refresh of the player dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rinkframe.operators import discovery, flatten
from rinkframe.sinks import tables as sink
from rinkframe.sources import feeds
from rinkframe.sources.zones import Archive, zone_of
from rinkframe.specs import PLAYERS


def wanted_ids(
    spark: SparkSession, players_table: str, plays_table: str | None = None, ids: str | None = None
) -> DataFrame:
    """Player ids to refresh: a comma-separated text, or those new in the plays."""
    if (ids is None) == (plays_table is None):
        raise ValueError("give either ids or a plays table")
    if ids is not None:
        return spark.createDataFrame([(ids,)], "ids string").select(
            feeds.id_list(F.col("ids")).alias("player_id")).distinct()
    found = discovery.player_ids(spark.table(plays_table))
    return discovery.missing_players(found, spark.table(players_table))


def player_rows(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the asked-for players; documents that cannot be used are skipped."""
    keyed = documents.where(~F.col("is_broken")).withColumn(
        "player_id", F.col("request_key").try_cast("bigint"))
    asked = keyed.join(ids, "player_id", "left_semi").drop("player_id")
    return flatten.players(asked).where(F.col("player_id").isNotNull())


def refresh_players(
    spark: SparkSession,
    landing: str | Archive,
    players_table: str,
    plays_table: str | None = None,
    ids: str | None = None,
) -> int:
    """Upsert players from their documents; returns the number of rows.

    Of an archive only the buckets of the wanted ids are read.
    """
    sink.create_if_missing(spark, players_table, PLAYERS)
    asked = wanted_ids(spark, players_table, plays_table, ids)
    keys = asked.select(F.col("player_id").cast("string").alias("request_key"))
    rows = player_rows(zone_of(spark, landing).of("player", keys), asked)
    return sink.upsert(rows, players_table, PLAYERS, ["player_id"])
