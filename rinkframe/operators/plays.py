"""Play-by-play documents to rows of the plays table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rinkframe.functions import clock, codes, coerce
from rinkframe.operators import carry, onice
from rinkframe.specs import PLAYS

# Output column of each player role and its field in ``details``.
ROLES = {
    "shooter_id": "shootingPlayerId",
    "goalie_id": "goalieInNetId",
    "scorer_id": "scoringPlayerId",
    "primary_assist_id": "assist1PlayerId",
    "secondary_assist_id": "assist2PlayerId",
    "hitter_id": "hittingPlayerId",
    "hittee_id": "hitteePlayerId",
    "winning_player_id": "winningPlayerId",
    "losing_player_id": "losingPlayerId",
    "drawn_by_id": "drawnByPlayerId",
    "served_by_id": "servedByPlayerId",
    "penalty_player_id": "committedByPlayerId",
    "blocker_id": "blockingPlayerId",
}


def _team(doc: str, landing: str, side: str, field: str) -> Column:
    """Team field of the first document whose team is filled in at all."""
    own = F.col(f"{doc}.{side}")
    filled = own["id"].isNotNull() | own["abbrev"].isNotNull()
    return F.when(filled, own[field]).otherwise(F.col(f"{landing}.{side}.{field}"))


def header(doc: str = "doc", landing: str = "landing") -> dict[str, Column]:
    """Game-level columns: play-by-play document first, landing document second."""
    number = lambda f: codes.first_number(F.col(f"{doc}.{f}"), F.col(f"{landing}.{f}"))
    return {
        "game_id": number("id"),
        "game_date": codes.first_text(F.col(f"{doc}.gameDate"), F.col(f"{landing}.gameDate")),
        "season": clock.season_start(number("season")),
        "game_type": codes.game_type(number("gameType")),
        "home_team_id": _team(doc, landing, "homeTeam", "id"),
        "away_team_id": _team(doc, landing, "awayTeam", "id"),
        "home_team_abbrev": _team(doc, landing, "homeTeam", "abbrev"),
        "away_team_abbrev": _team(doc, landing, "awayTeam", "abbrev"),
    }


def header_is_bad(doc: str = "doc", landing: str = "landing") -> Column:
    """A game without id, season, type or one of its teams cannot be unpacked."""
    h = header(doc, landing)
    kind = codes.first_number(F.col(f"{doc}.gameType"), F.col(f"{landing}.gameType"))
    return (
        h["game_id"].isNull() | h["season"].isNull() | kind.isNull()
        | h["home_team_id"].isNull() | h["away_team_id"].isNull()
    )


def clock_is_bad(plays: Column) -> Column:
    """Some play with a period has text that is no clock."""
    bad = F.exists(
        plays,
        lambda p: p["periodDescriptor"]["number"].isNotNull() & clock.clock_is_bad(p["timeInPeriod"]),
    )
    return F.coalesce(bad, F.lit(False))


def play_rows(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per play with ``pos``, its place in the document.

    ``documents`` is a document frame with a ``landing`` struct beside ``doc``.
    Scores are still those of the feed (``home_score``, ``away_score``). ``keep``
    names columns of the document to carry along.
    """
    h = header()
    p = F.col("play")
    d = p["details"]
    unpacked = documents.select(
        *(v.alias(k) for k, v in h.items()), *keep, F.posexplode("doc.plays").alias("pos", "play")
    )
    kind = codes.event_type(p["typeDescKey"])
    period = p["periodDescriptor"]["number"].cast("bigint")
    sides = codes.situation(p["situationCode"])
    return unpacked.select(
        *h,
        *keep,
        "pos",
        p["eventId"].alias("event_id"),
        p["sortOrder"].alias("sort_order"),
        period.alias("period"),
        p["periodDescriptor"]["periodType"].alias("period_type"),
        p["timeInPeriod"].alias("time_in_period"),
        p["timeRemaining"].alias("time_remaining"),
        clock.abs_seconds(period, clock.clock_seconds(p["timeInPeriod"]))
        .alias("event_abs_seconds"),
        kind.alias("event_type"),
        p["typeDescKey"].alias("event_type_desc"),
        p["situationCode"].alias("situation_code"),
        d["xCoord"].alias("x_coord"),
        d["yCoord"].alias("y_coord"),
        d["zoneCode"].alias("zone_code"),
        codes.zone_descriptor(d["zoneCode"]).alias("zone_descriptor"),
        d["eventOwnerTeamId"].alias("event_owner_team_id"),
        *(d[f].alias(c) for c, f in ROLES.items()),
        F.when(kind.isin("GIVEAWAY", "TAKEAWAY"), d["playerId"]).alias("committed_by_id"),
        d["shotType"].alias("shot_type"),
        d["duration"].alias("penalty_minutes"),
        codes.penalty_severity(d["typeCode"]).alias("penalty_severity"),
        d["typeCode"].alias("penalty_type_code"),
        d["descKey"].alias("penalty_type_desc"),
        d["homeScore"].alias("home_score"),
        d["awayScore"].alias("away_score"),
        sides["home_skaters"].alias("home_skaters_on_ice"),
        sides["away_skaters"].alias("away_skaters_on_ice"),
        sides["home_goalie"].alias("home_goalie_on_ice"),
        sides["away_goalie"].alias("away_goalie_on_ice"),
    )


_NARROW = ("pos", "event_abs_seconds", "home_team_id", "away_team_id", "home_score", "away_score")
_ANSWERS = (
    "pos", "home_score_before", "home_score_after", "away_score_before", "away_score_after",
    "home_on_ice_ids", "away_on_ice_ids", "source_quality",
)


def running(rows: DataFrame, merge_shifts: DataFrame, key: str = "game_id") -> DataFrame:
    """What the game stands at for every play: carried scores and players on the ice.

    One narrow row per play, named by ``key`` and ``pos``.
    """
    scored = carry.carry_scores(
        rows.select(*dict.fromkeys((key, *_NARROW))), "pos",
        {"home_score": "home_score", "away_score": "away_score"}, keys=(key,))
    iced = onice.with_on_ice(
        scored, merge_shifts.withColumnRenamed("game_id", key), event="pos", game=key)
    return iced.select(key, *_ANSWERS)


def complete_plays(rows: DataFrame, merge_shifts: DataFrame, key: str = "game_id") -> DataFrame:
    """Play rows with carried scores, players on the ice and strength label.

    ``key`` names the game that a document was asked for, which is also the game of
    its shifts; the id inside the document may differ and is only put out.

    Scores and players are found on the few columns they need; the wide rows are
    shuffled once, to meet the finished answers by game and place (``pos`` is unique
    within a game). ``rows`` is read more than once; hand over a stored frame where
    computing it is dear.
    """
    label = codes.strength_state(
        F.col("home_skaters_on_ice"), F.col("away_skaters_on_ice"),
        F.col("home_goalie_on_ice"), F.col("away_goalie_on_ice"),
    )
    answers = running(rows, merge_shifts, key).withColumnsRenamed({key: "_game", "pos": "_pos"})
    met = rows.join(answers, (F.col(key) == F.col("_game")) & (F.col("pos") == F.col("_pos")))
    finished = met.withColumn(
        "strength_state",
        codes.gated_strength(F.col("period_type"), F.col("source_quality"), label),
    ).withColumn("ingested_at", F.current_timestamp())
    return coerce.conform(finished, PLAYS)
