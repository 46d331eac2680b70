"""Codes of the feeds and the labels derived from them."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# Codes sent by the feeds and their published names.
GAME_TYPES = {1: "PR", 2: "R", 3: "P", 4: "AS"}
EVENT_TYPES = {
    "goal": "GOAL",
    "shot-on-goal": "SHOT",
    "missed-shot": "MISSED_SHOT",
    "blocked-shot": "BLOCKED_SHOT",
    "hit": "HIT",
    "faceoff": "FACEOFF",
    "giveaway": "GIVEAWAY",
    "takeaway": "TAKEAWAY",
    "penalty": "PENALTY",
    "stoppage": "STOPPAGE",
    "period-start": "PERIOD_START",
    "period-end": "PERIOD_END",
    "game-end": "GAME_END",
    "shootout-complete": "SHOOTOUT_COMPLETE",
    "delayed-penalty": "DELAYED_PENALTY",
}
PENALTY_SEVERITIES = ("MIN", "MAJ", "MIS", "BEN", "MAT", "GAM", "PS")
ZONES = {"O": "offensive", "D": "defensive", "N": "neutral"}


def _lookup(values: dict, key: Column) -> Column:
    table = F.create_map(*map(F.lit, chain.from_iterable(values.items())))
    return F.element_at(table, key)


def game_type(number: Column) -> Column:
    return _lookup(GAME_TYPES, number.cast("int"))


def event_type(key: Column) -> Column:
    return _lookup(EVENT_TYPES, key)


def penalty_severity(code: Column) -> Column:
    return F.when(code.isin(*PENALTY_SEVERITIES), code)


def zone_descriptor(letter: Column) -> Column:
    return _lookup(ZONES, letter)


def situation(code: Column) -> dict[str, Column]:
    """Counts and goalie flags of a four-digit situation code, else NULLs."""
    valid = code.rlike("^[0-9]{4}$")

    def digit(i):
        return F.when(valid, F.substring(code, i, 1).try_cast("bigint"))

    return {
        "away_goalie": digit(1) == 1,
        "away_skaters": digit(2),
        "home_skaters": digit(3),
        "home_goalie": digit(4) == 1,
    }


def strength_state(home: Column, away: Column, home_goalie: Column, away_goalie: Column) -> Column:
    """Label of the players on the ice; a pulled goalie outranks the counts."""
    known = home.isNotNull() & away.isNotNull() & home_goalie.isNotNull() & away_goalie.isNotNull()
    return (
        F.when(~known | (home < 1) | (away < 1), None)
        .when(~home_goalie & away_goalie, "EN_H")
        .when(home_goalie & ~away_goalie, "EN_A")
        .when((home == 5) & (away == 5), "EV")
        .when(home == away, F.concat_ws("v", home.cast("string"), away.cast("string")))
        .when(home > away, "PP_H")
        .otherwise("PP_A")
    )


def gated_strength(period_type: Column, quality: Column, label: Column) -> Column:
    """Strength label, withheld in shootouts and in games without shifts."""
    so = F.coalesce(period_type == "SO", F.lit(False))
    return F.when(~so & (quality == "FULL"), label)


def shootout_decided(last_period_type: Column) -> Column:
    return F.nullif(last_period_type, F.lit("")) == "SO"


def official_role(kind: str, position: Column) -> Column:
    """``REFEREE_1`` from the kind and a position counted from 0."""
    return F.concat(F.lit(f"{kind}_"), (position + 1).cast("string"))


def full_name(first: Column, last: Column) -> Column:
    blank = F.lit("")
    return F.nullif(F.concat_ws(" ", F.nullif(first, blank), F.nullif(last, blank)), blank)


def snake_case(name: str) -> str:
    """Column name of a camel-case feed field."""
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name).lstrip("_")


def abs_difference(a: Column, b: Column) -> Column:
    """Absolute difference, 0 when either side is missing."""
    return F.coalesce(F.abs(a - b), F.lit(0))


def or_default(value: Column, default) -> Column:
    """Feed number with 0 and NULL both replaced by a default."""
    return F.coalesce(F.nullif(value, F.lit(0)), F.lit(default))


def first_text(*texts: Column) -> Column:
    """First text that is neither NULL nor empty, else the last one."""
    return F.coalesce(*(F.nullif(t, F.lit("")) for t in texts[:-1]), texts[-1])


def first_number(*numbers: Column) -> Column:
    """First number that is neither NULL nor 0, else the last one."""
    return F.coalesce(*(F.nullif(n, F.lit(0)) for n in numbers[:-1]), numbers[-1])
