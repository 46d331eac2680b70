"""Players on the ice at every event: an interval join.

A plain join on the game and ``start <= t < end`` compares every event of a game
with every shift of it. Here three things keep the work near the size of the
result, also when one game holds a large part of all rows:

* events of one game at one second share their answer, so the join runs on the
  distinct seconds and the arrays are joined back;
* time is cut into buckets. A shift is copied to the few buckets it touches, on
  a level whose bucket width suits its length, and meets only the seconds of
  those buckets;
* a second that very many events share is split by blocks of event numbers, so
  that no task joins back more than one block of it. The events of a usual game
  lie in one or two blocks and stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FULL, NO_SHIFTS = "FULL", "NO_SHIFTS"
BUCKET_SECONDS = 60
# A shift touches at most this many buckets, plus one, of its level.
FAN_OUT = 64
_LEVELS = 3
_BLOCK = 1 << 18
_NEVER = -(2**63)
# The last level has one bucket for the whole game, kept in this many copies so that
# the seconds of one game do not all meet in one place.
_COPIES = 16


def _level_width(level: int, bucket: int) -> int:
    return bucket * FAN_OUT**level


def _shift_level(length: Column, bucket: int) -> Column:
    """Narrowest level on which the shift touches few buckets; the last has one."""
    level = F.when(length <= FAN_OUT * _level_width(0, bucket), 0)
    for n in range(1, _LEVELS - 1):
        level = level.when(length <= FAN_OUT * _level_width(n, bucket), n)
    return level.otherwise(_LEVELS - 1)


def _bucket_of(level: Column, second: Column, bucket: int) -> Column:
    """Bucket number of a second; on the last level the whole game is one."""
    number = F.when(level == 0, F.floor(second / _level_width(0, bucket)))
    for n in range(1, _LEVELS - 1):
        number = number.when(level == n, F.floor(second / _level_width(n, bucket)))
    return number.otherwise(F.lit(0)).cast("bigint")


def bucketed_shifts(
    shifts: DataFrame,
    game: str = "game_id",
    team: str = "team_id",
    player: str = "player_id",
    start: str = "start_abs_seconds",
    end: str = "end_abs_seconds",
    bucket: int = BUCKET_SECONDS,
) -> DataFrame:
    """Shifts copied to the buckets they touch, and one marker row per game.

    The marker sits on the last level and says that the game has shifts at all,
    empty and inverted ones included.
    """
    columns = [
        F.col(game).cast("bigint").alias("s_game"),
        F.col(team).cast("bigint").alias("s_team"),
        F.col(player).alias("s_player"),
        F.col(start).cast("bigint").alias("s_start"),
        F.col(end).cast("bigint").alias("s_end"),
    ]
    level = F.col("s_level")
    rows = (
        shifts.select(*columns)
        .where(F.col("s_end") > F.col("s_start"))
        .withColumn("s_level", _shift_level(F.col("s_end") - F.col("s_start"), bucket))
        .withColumn(
            "s_bucket",
            F.explode(F.sequence(
                _bucket_of(level, F.col("s_start"), bucket),
                _bucket_of(level, F.col("s_end") - 1, bucket),
            )),
        )
    )
    markers = shifts.select(F.col(game).cast("bigint").alias("s_game")).distinct().select(
        "s_game",
        F.lit(_LEVELS - 1).alias("s_level"),
        F.lit(0).cast("bigint").alias("s_bucket"),
        F.lit(True).alias("s_marker"),
    )
    marked = rows.withColumn("s_marker", F.lit(False)).unionByName(markers, allowMissingColumns=True)
    copies = F.when(level == _LEVELS - 1, F.sequence(F.lit(0), F.lit(_COPIES - 1))).otherwise(
        F.array(F.lit(0)))
    return marked.withColumn("s_copy", F.explode(copies))


def with_on_ice(
    events: DataFrame,
    shifts: DataFrame,
    event: str = "event_id",
    game: str = "game_id",
    time: str = "event_abs_seconds",
    home: str = "home_team_id",
    away: str = "away_team_id",
    bucket: int = BUCKET_SECONDS,
    **shift_columns: str,
) -> DataFrame:
    """Events with ``home_on_ice_ids``, ``away_on_ice_ids`` and ``source_quality``.

    The ids are ascending lists, a player with two overlapping shifts counts
    twice, and players of other teams are left out. Games without any shift get
    empty lists and quality NO_SHIFTS; events without a time get empty lists.
    ``event`` is a number; it only splits seconds that very many events share.
    """
    # Plain join keys: NULL stands as a number that no shift can meet, so that the
    # aggregated answers are joined back without another shuffle.
    numbers = {"_g": game, "_t": time, "_h": home, "_a": away}
    tagged = events.select(
        "*",
        *(F.coalesce(F.col(c).cast("bigint"), F.lit(_NEVER)).alias(k) for k, c in numbers.items()),
        F.coalesce(F.floor(F.col(event) / _BLOCK), F.lit(0)).alias("_block"),
    )
    keys = [*numbers, "_block"]
    slots = tagged.select(*keys).distinct()

    level = F.col("level")
    probes = slots.withColumn(
        "level", F.explode(F.array(*(F.lit(n) for n in range(_LEVELS))))
    ).withColumns({
        "bucket": _bucket_of(level, F.col("_t"), bucket),
        "copy": F.when(level == _LEVELS - 1, F.pmod(F.xxhash64("_t", "_block"), F.lit(_COPIES)))
        .otherwise(F.lit(0)).cast("int"),
    })
    right = bucketed_shifts(shifts, game=game, bucket=bucket, **shift_columns)
    covers = F.col("s_marker") | (
        (F.col("s_start") <= F.col("_t"))
        & (F.col("_t") < F.col("s_end"))
        & ((F.col("s_team") == F.col("_h")) | (F.col("s_team") == F.col("_a")))
    )
    hits = probes.join(
        right,
        (F.col("_g") == F.col("s_game"))
        & (level == F.col("s_level"))
        & (F.col("bucket") == F.col("s_bucket"))
        & (F.col("copy") == F.col("s_copy"))
        & covers,
    )
    at_home = F.col("s_team") == F.col("_h")
    answers = hits.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(at_home, F.col("s_player")))).alias("home_ids"),
        F.array_sort(
            F.collect_list(F.when(~at_home & (F.col("s_team") == F.col("_a")), F.col("s_player")))
        ).alias("away_ids"),
    )

    joined = tagged.join(answers, keys, "left")
    empty = F.array().cast("array<bigint>")
    return joined.select(
        *events.columns,
        F.coalesce("home_ids", empty).alias("home_on_ice_ids"),
        F.coalesce("away_ids", empty).alias("away_on_ice_ids"),
        F.when(F.col("home_ids").isNotNull(), FULL).otherwise(NO_SHIFTS).alias("source_quality"),
    )
