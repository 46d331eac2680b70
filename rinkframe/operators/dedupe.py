"""One row per key.

Both are aggregations, not ranking windows: rows of a hot key are reduced before
the shuffle and never meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _pick(df: DataFrame, keys, order, choose) -> DataFrame:
    row = F.struct(*(F.col(c) for c in df.columns))
    chosen = df.groupBy(*keys).agg(choose(row, F.struct(*order)).alias("_row"))
    return chosen.select(*(F.col(f"_row.`{c}`").alias(c) for c in df.columns))


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The whole row that is last in ``order`` for each key."""
    return _pick(df, keys, order, F.max_by)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The whole row that is first in ``order`` for each key."""
    return _pick(df, keys, order, F.min_by)


def latest_games(score_rows: DataFrame, landing_rows: DataFrame) -> DataFrame:
    """Games of the score feed and of landing documents, one row per game.

    A landing row replaces a score row as a whole; among rows of one source the
    later one (``feed_date``, ``pos``) wins.
    """
    both = score_rows.withColumn("source_rank", F.lit(0)).unionByName(
        landing_rows.withColumn("source_rank", F.lit(1)), allowMissingColumns=True
    )
    picked = keep_last(both, ["game_id"], ["source_rank", "feed_date", "pos"])
    return picked.drop("source_rank", "feed_date", "pos")


def work_list(score_games: DataFrame, include_preseason: bool = False) -> DataFrame:
    """Games to fetch: ``game_id``, ``game_date``, ``feed_date``; the first listing wins.

    ``score_games`` comes from ``flatten.score_games``. Preseason games (type 1)
    are left out unless asked for; a game without a type stays.
    """
    g = F.col("game")
    listed = score_games if include_preseason else score_games.where(
        F.coalesce(g["gameType"], F.lit(0)) != 1
    )
    rows = listed.select(
        g["id"].alias("game_id"),
        F.coalesce(F.nullif(g["gameDate"], F.lit("")), F.col("feed_date").cast("string"))
        .alias("game_date"),
        "feed_date",
        "pos",
    )
    return keep_first(rows, ["game_id"], ["feed_date", "pos"])
