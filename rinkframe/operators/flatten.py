"""Feed documents to rows of the tables.

Each function takes a document frame (see ``sources.feeds``) and returns one row
per element. Nothing here shuffles: a document is unpacked where it was read.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from rinkframe.functions import clock, codes, coerce
from rinkframe.specs import BOXSCORE, GAMES, OFFICIALS, PLAYERS, SHIFTS, STANDINGS


def _key_as_id() -> Column:
    return F.col("request_key").try_cast("bigint")


def _now() -> Column:
    return F.current_timestamp()


# --- games -------------------------------------------------------------------


def _game_columns(g: str, date: Column) -> dict[str, Column]:
    """Columns of ``games`` from a game struct at path ``g``."""
    c = lambda name: F.col(f"{g}.{name}")
    return {
        "game_id": c("id"),
        "game_date": date,
        "season": clock.season_start(codes.or_default(c("season"), 0)),
        "game_type": codes.game_type(codes.or_default(c("gameType"), 2)),
        "home_team_id": c("homeTeam.id"),
        "away_team_id": c("awayTeam.id"),
        "home_team_abbrev": c("homeTeam.abbrev"),
        "away_team_abbrev": c("awayTeam.abbrev"),
        "venue_default_name": c("venue.default"),
        "start_time_utc": c("startTimeUTC"),
        "eastern_utc_offset": c("easternUTCOffset"),
        "venue_utc_offset": c("venueUTCOffset"),
        "game_state": c("gameState"),
        "home_score_final": c("homeTeam.score"),
        "away_score_final": c("awayTeam.score"),
        "ingested_at": _now(),
    }


def score_games(score: DataFrame) -> DataFrame:
    """Elements of the daily score feed with their position."""
    return score.select("feed_date", F.posexplode("doc.games").alias("pos", "game"))


def games_from_score(score: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One ``games`` row per game of a score document, before any enrichment."""
    date = codes.first_text(F.col("game.gameDate"), F.col("feed_date").cast("string"))
    columns = _game_columns("game", date)
    rows = score_games(score).select("feed_date", "pos", *(v.alias(k) for k, v in columns.items()))
    return coerce.conform(rows, GAMES, keep)


def games_from_landing(landing: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One ``games`` row per landing document."""
    last = F.col("doc.gameOutcome.lastPeriodType")
    columns = _game_columns("doc", F.col("doc.gameDate")) | {
        "final_period_type": last,
        "is_shootout_decided": codes.shootout_decided(last),
    }
    rows = landing.select(*keep, *(v.alias(k) for k, v in columns.items()))
    return coerce.conform(rows, GAMES, keep)


# --- officials, boxscore, standings, players ---------------------------------


def officials(right_rail: DataFrame) -> DataFrame:
    """One row per referee and linesman; ``game_date`` is that of the work list."""
    def numbered(kind: str, field: str) -> Column:
        people = F.coalesce(F.col(f"doc.gameInfo.{field}"), F.array().cast(
            "array<struct<default: string, sweaterNumber: string>>"))
        return F.transform(
            people,
            lambda p, i: F.struct(
                codes.official_role(kind, i).alias("role"),
                p["default"].alias("official_name"),
                p["sweaterNumber"].alias("official_number"),
            ),
        )

    people = F.concat(numbered("REFEREE", "referees"), numbered("LINESMAN", "linesmen"))
    game_date = F.col("game_date") if "game_date" in right_rail.columns else F.col("feed_date")
    rows = right_rail.select(
        _key_as_id().alias("game_id"), game_date.alias("game_date"), F.inline(people)
    )
    return coerce.conform(rows.withColumn("ingested_at", _now()), OFFICIALS)


# Player fields copied as they are, goalie fields after them.
_COPIED = (
    "goals", "assists", "points", "plusMinus", "pim", "hits", "blockedShots", "shots",
    "faceoffs", "faceoffWinningPctg", "powerPlayGoals", "powerPlayPoints", "shorthandedGoals",
    "shPoints", "powerPlayToi", "shorthandedToi", "savePctg", "goalsAgainst",
    "evenStrengthShotsAgainst", "powerPlayShotsAgainst", "shorthandedShotsAgainst",
    "evenStrengthGoalsAgainst", "powerPlayGoalsAgainst", "shorthandedGoalsAgainst",
)


def boxscore_players(boxscore: DataFrame) -> DataFrame:
    """Every player of a boxscore with team, category and place in the document.

    The six lists of a document are put behind each other, home side first, and
    unpacked at once; ``place`` counts through them, so that of two entries of one
    player the later one can be told.
    """
    kind = boxscore.schema["doc"].dataType["playerByGameStats"].dataType
    none = F.array().cast(kind["homeTeam"].dataType["forwards"].dataType)
    lists = [
        F.coalesce(F.col(f"doc.playerByGameStats.{side}.{group}"), none)
        for side in ("homeTeam", "awayTeam") for group in ("forwards", "defense", "goalies")
    ]
    sizes = [F.size(x) for x in lists]
    place = F.col("place")
    unpacked = boxscore.select(
        F.col("doc.id").alias("game_id"),
        F.col("doc.gameDate").alias("game_date"),
        F.col("doc.homeTeam.id").alias("home_id"),
        F.col("doc.awayTeam.id").alias("away_id"),
        (sizes[0] + sizes[1]).alias("home_goalies_from"),
        (sizes[0] + sizes[1] + sizes[2]).alias("away_from"),
        reduce(add, sizes[:5]).alias("away_goalies_from"),
        F.posexplode(F.concat(*lists)).alias("place", "player"),
    )
    at_home = place < F.col("away_from")
    in_net = F.when(at_home, place >= F.col("home_goalies_from")).otherwise(
        place >= F.col("away_goalies_from"))
    return unpacked.select(
        "game_id",
        "game_date",
        F.when(at_home, F.col("home_id")).otherwise(F.col("away_id")).alias("team_id"),
        F.when(in_net, "goalie").otherwise("skater").alias("category"),
        "player",
        "place",
    )


def boxscore(documents: DataFrame) -> DataFrame:
    """One row per player and game."""
    p = F.col("player")
    saves, shots = coerce.save_counts(p["saveShotsAgainst"], p["saves"], p["shotsAgainst"])
    rows = boxscore_players(documents).select(
        "game_id",
        "game_date",
        p["playerId"].alias("player_id"),
        "team_id",
        F.col("category").alias("player_position_category"),
        p["position"].alias("position_code"),
        p["sweaterNumber"].alias("sweater_number"),
        p["toi"].alias("toi"),
        *(p[f].alias(codes.snake_case(f)) for f in _COPIED),
        shots.alias("shots_against"),
        saves.alias("saves"),
        _now().alias("ingested_at"),
    )
    return coerce.conform(rows, BOXSCORE)


def standings(documents: DataFrame) -> DataFrame:
    """One row per team and day asked for."""
    s = F.col("team")
    rows = documents.select("request_key", F.explode("doc.standings").alias("team")).select(
        F.col("request_key").alias("snapshot_date"),
        F.coalesce(
            F.nullif(s["teamAbbrev"]["id"], F.lit(0)), s["teamCommonName"]["id"]
        ).alias("team_id"),
        s["teamAbbrev"]["default"].alias("team_abbrev"),
        s["teamName"]["default"].alias("team_name"),
        *(
            s[f].alias(codes.snake_case(f))
            for f in (
                "conferenceName", "divisionName", "gamesPlayed", "wins", "losses", "otLosses",
                "points", "goalFor", "goalAgainst", "goalDifferential", "regulationWins",
                "regulationPlusOtWins",
            )
        ),
        _now().alias("ingested_at"),
    )
    return coerce.conform(rows, STANDINGS)


def players(documents: DataFrame) -> DataFrame:
    """One row per player document."""
    d = F.col("doc")
    first, last = d["firstName"]["default"], d["lastName"]["default"]
    rows = documents.select(
        d["playerId"].alias("player_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        codes.full_name(first, last).alias("full_name"),
        d["position"].alias("position_code"),
        d["sweaterNumber"].alias("sweater_number"),
        d["currentTeamAbbrev"].alias("current_team_abbrev"),
        d["shootsCatches"].alias("shoots_catches"),
        d["birthDate"].alias("birth_date"),
        d["birthCountry"].alias("birth_country"),
        d["heightInInches"].alias("height_inches"),
        d["weightInPounds"].alias("weight_pounds"),
        d["headshot"].alias("headshot_url"),
        _now().alias("ingested_at"),
    )
    return coerce.conform(rows, PLAYERS)


def season_totals(documents: DataFrame, season_code) -> DataFrame:
    """First regular-season league total of each player for one season code.

    ``season_code`` is a number or a column.
    """
    wanted = F.filter(
        F.col("doc.seasonTotals"),
        lambda t: (t["season"] == season_code) & (t["leagueAbbrev"] == "NHL")
        & (t["gameTypeId"] == 2),
    )
    rows = documents.select(
        F.col("doc.playerId").alias("player_id"), F.get(wanted, F.lit(0)).alias("total")
    ).where(F.col("total").isNotNull())
    fields = ("goals", "assists", "points", "plusMinus", "pim", "hits", "blockedShots", "shots")
    return rows.select(
        "player_id", *(F.col(f"total.{f}").alias(codes.snake_case(f)) for f in fields)
    )


# --- shifts ------------------------------------------------------------------


def _shift_number_text(s: Column) -> Column:
    """Text of the shift number, a variant; NULL if it is absent or an explicit NULL."""
    return F.try_variant_get(s["shiftNumber"], "$", "string")


def _shift_numbers(s: Column) -> dict[str, Column]:
    """Typed parts of one raw shift struct."""
    return {
        "game_id": coerce.whole_number(s["gameId"]),
        "player_id": coerce.whole_number(s["playerId"]),
        "team_id": coerce.whole_number(s["teamId"]),
        "period": coerce.whole_number(s["period"]),
        "shift_number": coerce.whole_number(_shift_number_text(s)),
        "start": clock.clock_seconds(s["startTime"]),
        "end": clock.clock_seconds(s["endTime"]),
    }


def shift_number_is_bad(s: Column) -> Column:
    """Shift number that is there but is no number."""
    raw = _shift_number_text(s)
    return raw.isNotNull() & (raw != "") & coerce.whole_number(raw).isNull()


def shift_row_is_timed(s: Column) -> Column:
    """Raw shift whose period and times can be read and which is not empty."""
    n = _shift_numbers(s)
    return F.coalesce(n["period"].isNotNull() & (n["end"] > n["start"]), F.lit(False))


def shift_row_is_bad(s: Column) -> Column:
    """Timed shift without the ids that its row needs."""
    n = _shift_numbers(s)
    ids_missing = n["game_id"].isNull() | n["player_id"].isNull() | n["team_id"].isNull()
    return shift_row_is_timed(s) & (ids_missing | shift_number_is_bad(s))


def shifts(documents: DataFrame) -> DataFrame:
    """Rows of the shifts table; untimed and empty shifts are left out."""
    game_date = F.col("game_date") if "game_date" in documents.columns else F.col("feed_date")
    s = F.col("shift")
    raw = documents.select(game_date.alias("game_date"), F.explode("doc.data").alias("shift"))
    n = _shift_numbers(s)
    rows = raw.where(shift_row_is_timed(s)).select(
        n["game_id"].alias("game_id"),
        "game_date",
        n["player_id"].alias("player_id"),
        n["team_id"].alias("team_id"),
        F.coalesce(n["shift_number"], F.lit(0)).alias("shift_number"),
        n["period"].alias("period"),
        clock.shift_period_type(n["period"]).alias("period_type"),
        s["startTime"].alias("start_in_period"),
        s["endTime"].alias("end_in_period"),
        clock.abs_seconds(n["period"], n["start"]).alias("start_abs_seconds"),
        clock.abs_seconds(n["period"], n["end"]).alias("end_abs_seconds"),
        (n["end"] - n["start"]).alias("duration_seconds"),
        _now().alias("ingested_at"),
    )
    return coerce.conform(rows, SHIFTS)


def _numbered_shifts(documents: DataFrame, *columns: Column) -> DataFrame:
    """One row per raw shift with its typed parts, each worked out once."""
    return documents.select(*columns, F.inline(F.transform(
        F.col("doc.data"),
        lambda s: F.struct(
            *(v.alias("shift_" + k) for k, v in _shift_numbers(s).items() if k != "game_id"),
            s["shiftNumber"].isNull().alias("shift_unnumbered"),
        ),
    )))


def merge_shifts(documents: DataFrame) -> DataFrame:
    """Shifts used to find who was on the ice.

    Unreadable shifts are left out, as are those whose number is there but NULL;
    empty and inverted ones stay, as they count as shift data of their game. The game is the one the document was asked for.
    """
    raw = _numbered_shifts(documents, _key_as_id().alias("game_id"))
    period = F.col("shift_period")
    return raw.select(
        "game_id",
        F.col("shift_player_id").alias("player_id"),
        F.col("shift_team_id").alias("team_id"),
        period.alias("period"),
        F.when(F.col("shift_unnumbered"), 0).otherwise(F.col("shift_shift_number"))
        .alias("shift_number"),
        clock.abs_seconds(period, F.col("shift_start")).alias("start_abs_seconds"),
        clock.abs_seconds(period, F.col("shift_end")).alias("end_abs_seconds"),
    ).where(
        (F.col("period") >= 1)
        & F.col("player_id").isNotNull()
        & F.col("team_id").isNotNull()
        & F.col("shift_number").isNotNull()
        & F.col("start_abs_seconds").isNotNull()
        & F.col("end_abs_seconds").isNotNull()
    )
