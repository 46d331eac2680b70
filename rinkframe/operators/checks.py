"""Consistency checks of stored tables.

Each check gives one row ``(name, violations, total, passed)``. The checks that
look at single plays share one scan and one aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rinkframe.functions import clock
from rinkframe.specs import TableSpec


def _size(name: str) -> Column:
    return F.size(F.coalesce(F.col(name), F.array().cast("array<bigint>")))


def _usable() -> Column:
    """Rows outside shootouts in games with shifts; a NULL period type is out."""
    return (F.col("period_type") != "SO") & (F.col("source_quality") == "FULL")


def _on_ice_count() -> tuple[Column, Column]:
    odd = ~_size("home_on_ice_ids").between(3, 6) | ~_size("away_on_ice_ids").between(3, 6)
    return _usable(), odd


def _orphan_player() -> tuple[Column, Column]:
    at_home = F.col("event_owner_team_id") == F.col("home_team_id")
    side = F.when(at_home, F.col("home_on_ice_ids")).otherwise(F.col("away_on_ice_ids"))
    ids = F.coalesce(side, F.array().cast("array<bigint>"))
    shooter = F.col("shooter_id")
    absent = shooter.isNotNull() & ~F.array_contains(ids, shooter)
    return _usable() & F.col("event_owner_team_id").isNotNull(), absent


def _score_monotonic() -> tuple[Column, Column]:
    scope = F.col("home_score_before").isNotNull() & F.col("home_score_after").isNotNull()
    falls = (F.col("home_score_after") < F.col("home_score_before")) | (
        F.col("away_score_after") < F.col("away_score_before"))
    return scope, falls


def _period_time() -> tuple[Column, Column]:
    return F.lit(True), clock.clock_minutes(F.col("time_in_period")) > 20


def _coords() -> tuple[Column, Column]:
    x, y = F.col("x_coord"), F.col("y_coord")
    fine = (x.between(-100, 100) & y.between(-42.5, 42.5)) | (x.isNull() & y.isNull())
    return F.lit(True), ~fine


PLAY_CHECKS = {
    "on_ice_skater_count_valid": _on_ice_count,
    "no_orphan_event_player": _orphan_player,
    "score_monotonic": _score_monotonic,
    "period_time_in_bounds": _period_time,
    "coords_in_bounds_or_null": _coords,
}


def _tally(df: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per check from one aggregation; a NULL condition is no violation."""
    counts = []
    for scope, bad in checks.values():
        counts += [F.count_if(scope & bad), F.count_if(scope)]
    row = df.agg(*(c.alias(f"n{i}") for i, c in enumerate(counts)))
    pairs = F.array(*(
        F.struct(
            F.lit(name).alias("name"),
            F.col(f"n{2 * i}").alias("violations"),
            F.col(f"n{2 * i + 1}").alias("total"),
        )
        for i, name in enumerate(checks)
    ))
    return _with_verdict(row.select(F.inline(pairs)))


def _with_verdict(df: DataFrame) -> DataFrame:
    return df.withColumn("passed", F.col("violations") == 0)


def play_checks(plays: DataFrame, names=tuple(PLAY_CHECKS)) -> DataFrame:
    """Some or all checks of single plays."""
    return _tally(plays, {n: PLAY_CHECKS[n]() for n in names})


def duplicate_events(
    plays: DataFrame, keys: tuple[str, ...] = ("game_id", "event_id")
) -> DataFrame:
    """Keys that occur more than once, out of all rows."""
    groups = plays.groupBy(*keys).agg(F.count("*").alias("n"))
    counted = groups.agg(
        F.count_if(F.col("n") > 1).alias("violations"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    return _with_verdict(counted.select(F.lit("no_duplicate_events").alias("name"), "*"))


def future_games(games: DataFrame, today: Column | None = None) -> DataFrame:
    """Finished games dated after today."""
    today = F.current_date() if today is None else today
    finished = F.col("game_state").isin("FINAL", "OFF")
    return _tally(games, {"no_future_games": (finished, F.col("game_date") > today)})


def shift_intervals(shifts: DataFrame) -> DataFrame:
    """Shifts that do not end after they start."""
    bad = F.col("start_abs_seconds") >= F.col("end_abs_seconds")
    return _tally(shifts, {"shifts_valid_intervals": (F.lit(True), bad)})


def internal_checks(
    plays: DataFrame, shifts: DataFrame, games: DataFrame, today: Column | None = None
) -> DataFrame:
    """All eight checks."""
    parts = [
        play_checks(plays), duplicate_events(plays), future_games(games, today),
        shift_intervals(shifts),
    ]
    return reduce(DataFrame.unionByName, parts)


def overall(checks: DataFrame) -> DataFrame:
    """One row: whether every check passed."""
    return checks.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("overall_pass"))


def conformance(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that break what the column specifications declare.

    Spark tables do not enforce required columns, ranges or value lists.
    """
    checks = {}
    for c in spec.columns:
        value = F.col(c.name)
        if c.mode == "REQUIRED":
            checks[f"{c.name}.required"] = (F.lit(True), value.isNull())
        if c.domain:
            checks[f"{c.name}.range"] = (value.isNotNull(), ~value.between(*c.domain))
        if c.values:
            checks[f"{c.name}.values"] = (value.isNotNull(), ~value.isin(*c.values))
    return _tally(df, checks)
