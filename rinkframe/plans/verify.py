"""Verification of stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rinkframe.functions import clock
from rinkframe.operators import checks, flatten, reconcile
from rinkframe.sources.zones import Archive, one_key, zone_of


def verify_internal(
    spark: SparkSession, plays: str, shifts: str, games: str, today: Column | None = None
) -> DataFrame:
    """The eight consistency checks."""
    return checks.internal_checks(spark.table(plays), spark.table(shifts), spark.table(games), today)


def verify_team_season(
    spark: SparkSession, plays: str, games: str, standings: str, season: int, **options
) -> DataFrame:
    """Team totals of a season against the stored standings of its last day."""
    last_day = F.col("snapshot_date") == clock.season_snapshot(F.lit(season))
    teams = reconcile.team_ids(spark.table(games), season)
    official = reconcile.resolve_team_ids(spark.table(standings).where(last_day), teams)
    totals = reconcile.team_totals(reconcile.game_outcomes(spark.table(plays), season))
    return reconcile.team_season(totals, official, **options)


def verify_player_season(
    spark: SparkSession, plays: str, landing: str | Archive, season: int, **options
) -> DataFrame:
    """Goals of a season against the totals in the player documents."""
    goals = reconcile.scorer_goals(spark.table(plays).where(F.col("season") == season))
    documents = zone_of(spark, landing).days("player")
    official = flatten.season_totals(documents, clock.season_code(F.lit(season)))
    return reconcile.player_season(goals, official, **options)


def verify_game_boxscore(
    spark: SparkSession, plays: str, landing: str | Archive, game_id: int
) -> DataFrame:
    """Goals of one game against its boxscore document.

    In an archive the game's day is looked up, and only that day is opened.
    """
    goals = reconcile.scorer_goals(spark.table(plays).where(F.col("game_id") == game_id))
    documents = zone_of(spark, landing).of("boxscore", one_key(spark, game_id))
    return reconcile.game_boxscore(goals, flatten.boxscore_players(documents))
