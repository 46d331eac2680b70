"""Players that occur in plays but not yet in the player dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rinkframe.operators.plays import ROLES

ID_COLUMNS = (*ROLES, "committed_by_id")
ARRAY_COLUMNS = ("home_on_ice_ids", "away_on_ice_ids")


def player_ids(
    plays: DataFrame, columns=ID_COLUMNS, arrays=ARRAY_COLUMNS, name: str = "player_id"
) -> DataFrame:
    """Distinct ids over all role columns and arrays, from a single scan."""
    singles = F.array(*(F.col(c).cast("bigint") for c in columns))
    none = F.array().cast("array<bigint>")
    lists = [F.coalesce(F.col(c), none) for c in arrays]
    return (
        plays.select(F.explode(F.concat(singles, *lists)).alias(name))
        .where(F.col(name).isNotNull())
        .distinct()
    )


def missing_players(ids: DataFrame, players: DataFrame, name: str = "player_id") -> DataFrame:
    return ids.join(players.select(name), name, "left_anti")
