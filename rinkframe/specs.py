"""Column specifications: one source for schemas, metadata and documentation.

Every table is a list of ``ColumnSpec``; ``struct_type`` turns it into a
``StructType`` whose fields carry the specification as metadata, which Spark
keeps with a saved table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Type names of the data dictionary and their Spark types.
SPARK_TYPES = {
    "INT64": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOL": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIME": T.StringType(),
    "NUMERIC": T.DecimalType(38, 9),
}
MODES = ("REQUIRED", "NULLABLE", "REPEATED")


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    mode: str
    summary: str
    definition: str = ""
    tags: tuple[str, ...] = ()
    domain: tuple[float, float] | None = None
    values: tuple[str, ...] | None = None
    example: object = None
    notes: tuple[str, ...] = ()
    source: str | None = None
    deprecated_in_year: int | None = None

    def __post_init__(self):
        if not self.definition:
            object.__setattr__(self, "definition", self.summary)
        if self.type not in SPARK_TYPES:
            raise ValueError(f"{self.name}: unknown type {self.type!r}")
        if self.mode not in MODES:
            raise ValueError(f"{self.name}: unknown mode {self.mode!r}")
        if not self.definition.strip():
            raise ValueError(f"{self.name}: a definition is needed")

    @property
    def spark_type(self) -> T.DataType:
        base = SPARK_TYPES[self.type]
        return T.ArrayType(base, containsNull=False) if self.mode == "REPEATED" else base

    @property
    def source_field(self) -> str:
        return self.source or "(derived)"

    def describe(self) -> str:
        """One text with everything the specification says about the column."""
        text = [self.definition]
        if self.values:
            text.append("One of " + ", ".join(self.values) + ".")
        if self.domain:
            text.append(f"Between {self.domain[0]:g} and {self.domain[1]:g}.")
        if self.example is not None:
            text.append(f"For example {self.example!r}.")
        text.extend(f"Note {i}: {note}" for i, note in enumerate(self.notes, 1))
        if self.source:
            text.append(f"Feed field {self.source}.")
        if self.deprecated_in_year is not None:
            text.append(f"Always NULL since {self.deprecated_in_year}.")
        return " ".join(text)

    def struct_field(self) -> T.StructField:
        meta = {
            "comment": self.describe(),
            "mode": self.mode,
            "tags": list(self.tags),
            "source_field": self.source_field,
        }
        if self.domain:
            meta["domain"] = list(self.domain)
        if self.values:
            meta["values"] = list(self.values)
        return T.StructField(self.name, self.spark_type, self.mode != "REQUIRED", meta)


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    partition_by: str | None = None
    cluster_by: tuple[str, ...] = field(default=())
    # Key that upserts go by, and how many hash buckets of it the table is dealt into.
    key: tuple[str, ...] = field(default=())
    buckets: int = 64

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def struct_type(self) -> T.StructType:
        return T.StructType([c.struct_field() for c in self.columns])


def _c(name, type_, summary, *, src=None, mode="NULLABLE", tags=(), **more):
    return ColumnSpec(name, type_, mode, summary, tags=tuple(tags), source=src, **more)


def _req(name, type_, summary, **more):
    return _c(name, type_, summary, mode="REQUIRED", **more)


# Value lists and ranges of the published tables.
GAME_TYPES = ("PR", "R", "P", "AS")
PERIOD_TYPES = ("REG", "OT", "SO")
POSITIONS = ("C", "L", "R", "D", "G")
EVENT_TYPES = (
    "GOAL", "SHOT", "MISSED_SHOT", "BLOCKED_SHOT", "HIT", "FACEOFF", "GIVEAWAY", "TAKEAWAY",
    "PENALTY", "STOPPAGE", "PERIOD_START", "PERIOD_END", "GAME_END", "SHOOTOUT_COMPLETE",
    "DELAYED_PENALTY",
)
SEASONS = (2010, 2050)
PERIODS = (1, 10)
GAME_SECONDS = (0, 12000)
SCORES = (0, 20)
SWEATERS = (1, 99)

_KEY = ("identifier", "join_key")
_TEAM = ("identifier", "join_key", "team")


def _ingested():
    return _req("ingested_at", "TIMESTAMP", "UTC time at which this row was written.", tags=["meta"])


def _player(name, summary, src, **more):
    return _c(name, "INT64", summary, src=src, tags=["identifier", "player"], **more)


def _count(name, summary, src, **more):
    return _c(name, "INT64", summary, src=src, tags=["statistic"], **more)


PLAYS = TableSpec(
    "nhl_plays",
    (
        _req("game_id", "INT64", "Game that the event belongs to.", src="id", tags=_KEY,
             example=2024020001),
        _req("event_id", "INT64", "Event number, unique within its game only.", src="eventId",
             tags=_KEY, notes=("Join on game_id as well.",)),
        _c("sort_order", "INT64", "Display order of the event in its game.", src="sortOrder",
           tags=["ordering"], domain=(1, 2000)),
        _req("season", "INT64", "Year in which the season starts.", src="season",
             tags=["temporal", "identifier"], domain=SEASONS, example=2024),
        _req("game_date", "DATE", "Calendar day of the game; partition column.", src="gameDate",
             tags=["temporal", "identifier"], example="2024-10-08"),
        _c("game_type", "STRING", "Kind of game as a short code.", src="gameType",
           tags=["identifier"], values=GAME_TYPES),
        _c("period", "INT64", "Period number; from 4 on overtime.", src="periodDescriptor.number",
           tags=["temporal"], domain=PERIODS),
        _c("period_type", "STRING", "Kind of period.", src="periodDescriptor.periodType",
           tags=["temporal"], values=PERIOD_TYPES),
        _c("time_in_period", "STRING", "Clock text counted up from the start of the period.",
           src="timeInPeriod", tags=["temporal"], example="12:34"),
        _c("time_remaining", "STRING", "Clock text counted down to the end of the period.",
           src="timeRemaining", tags=["temporal"]),
        _c("event_abs_seconds", "INT64", "Seconds since the start of the game.", tags=["temporal"],
           definition="Seconds since the start of the game, each period counted as 1200 seconds; "
                      "NULL when the event has no clock.",
           domain=GAME_SECONDS),
        _c("event_type", "STRING", "Normalised event code.", src="typeDescKey",
           tags=["classification"], values=EVENT_TYPES),
        _c("event_type_desc", "STRING", "Event key as sent by the feed.", src="typeDescKey",
           tags=["classification"]),
        _c("situation_code", "STRING",
           "Four digits: away goalie, away skaters, home skaters, home goalie.",
           src="situationCode", tags=["on_ice"], example="1551"),
        _c("x_coord", "FLOAT64", "Position along the rink, in feet from centre ice.",
           src="details.xCoord", tags=["coordinates"], domain=(-100, 100)),
        _c("y_coord", "FLOAT64", "Position across the rink, in feet from centre ice.",
           src="details.yCoord", tags=["coordinates"], domain=(-42.5, 42.5)),
        _c("zone_code", "STRING", "Zone letter seen from the owning team.", src="details.zoneCode",
           tags=["coordinates"], values=("O", "D", "N")),
        _c("zone_descriptor", "STRING", "Zone letter as a word.", tags=["coordinates"]),
        _c("event_owner_team_id", "INT64", "Team that the event is credited to.",
           src="details.eventOwnerTeamId", tags=_TEAM),
        _player("shooter_id", "Player who shot.", "details.shootingPlayerId",
                notes=("Read from another field than scorer_id; a goal may lack it.",)),
        _player("goalie_id", "Goalie facing the shot.", "details.goalieInNetId"),
        _player("scorer_id", "Player who scored.", "details.scoringPlayerId"),
        _player("primary_assist_id", "Player with the last pass.", "details.assist1PlayerId"),
        _player("secondary_assist_id", "Player with the pass before the last.",
                "details.assist2PlayerId"),
        _player("hitter_id", "Player who made the hit.", "details.hittingPlayerId"),
        _player("hittee_id", "Player who took the hit.", "details.hitteePlayerId"),
        _player("winning_player_id", "Player who won the faceoff.", "details.winningPlayerId"),
        _player("losing_player_id", "Player who lost the faceoff.", "details.losingPlayerId"),
        _player("drawn_by_id", "Player who drew the penalty.", "details.drawnByPlayerId"),
        _player("served_by_id", "Player who served the penalty.", "details.servedByPlayerId"),
        _player("penalty_player_id", "Player who was penalised.", "details.committedByPlayerId"),
        _player("blocker_id", "Player who blocked the shot.", "details.blockingPlayerId"),
        _player("committed_by_id", "Player behind a giveaway or takeaway, else NULL.",
                "details.playerId"),
        _c("shot_type", "STRING", "How the puck was shot.", src="details.shotType", tags=["shot"],
           values=("wrist", "slap", "snap", "backhand", "tip-in", "deflected", "wrap-around",
                   "poke", "bat")),
        _c("penalty_minutes", "INT64", "Length of the penalty in minutes.", src="details.duration",
           tags=["penalty"], domain=(2, 20)),
        _c("penalty_severity", "STRING", "Severity code, NULL if it is not a known one.",
           src="details.typeCode", tags=["penalty"],
           values=("MIN", "MAJ", "MIS", "BEN", "MAT", "GAM", "PS")),
        _c("penalty_type_code", "STRING", "Severity code as sent by the feed.",
           src="details.typeCode", tags=["penalty"]),
        _c("penalty_type_desc", "STRING", "Name of the infraction.", src="details.descKey",
           tags=["penalty"]),
        _c("home_score_before", "INT64", "Home goals before the event, carried along the game.",
           tags=["score_state"], domain=SCORES),
        _c("away_score_before", "INT64", "Away goals before the event, carried along the game.",
           tags=["score_state"], domain=SCORES),
        _c("home_score_after", "INT64", "Home goals after the event.", src="details.homeScore",
           tags=["score_state"], domain=SCORES),
        _c("away_score_after", "INT64", "Away goals after the event.", src="details.awayScore",
           tags=["score_state"], domain=SCORES),
        _req("home_team_id", "INT64", "Home team.", src="homeTeam.id", tags=_TEAM),
        _req("away_team_id", "INT64", "Away team.", src="awayTeam.id", tags=_TEAM),
        _c("home_team_abbrev", "STRING", "Short name of the home team.", src="homeTeam.abbrev",
           tags=["team"]),
        _c("away_team_abbrev", "STRING", "Short name of the away team.", src="awayTeam.abbrev",
           tags=["team"]),
        _c("home_on_ice_ids", "INT64", "Home players on the ice, ascending, goalie included.",
           mode="REPEATED", tags=["on_ice"]),
        _c("away_on_ice_ids", "INT64", "Away players on the ice, ascending, goalie included.",
           mode="REPEATED", tags=["on_ice"]),
        _c("home_skaters_on_ice", "INT64", "Home skaters, from the situation code.",
           tags=["on_ice"], domain=(0, 6)),
        _c("away_skaters_on_ice", "INT64", "Away skaters, from the situation code.",
           tags=["on_ice"], domain=(0, 6)),
        _c("home_goalie_on_ice", "BOOL", "Home goalie in the net, from the situation code.",
           tags=["on_ice"]),
        _c("away_goalie_on_ice", "BOOL", "Away goalie in the net, from the situation code.",
           tags=["on_ice"]),
        _c("strength_state", "STRING", "Label of the balance of players on the ice.",
           tags=["on_ice"],
           values=("EV", "PP_H", "PP_A", "SH_H", "SH_A", "EN_H", "EN_A", "4v4", "3v3")),
        _c("source_quality", "STRING", "Whether the game came with shifts.", tags=["quality"],
           values=("FULL", "NO_SHIFTS", "PARTIAL")),
        _ingested(),
    ),
    "game_date",
    ("home_team_abbrev", "away_team_abbrev", "game_id"),
)

GAMES = TableSpec(
    "games",
    (
        _req("game_id", "INT64", "Game identifier.", src="id", tags=_KEY, example=2024020001),
        _req("game_date", "DATE", "Calendar day of the game; partition column.", src="gameDate",
             tags=["temporal", "identifier"]),
        _req("season", "INT64", "Year in which the season starts.", src="season",
             tags=["temporal", "identifier"], domain=SEASONS),
        _c("game_type", "STRING", "Kind of game as a short code.", src="gameType",
           tags=["identifier"], values=GAME_TYPES),
        _req("home_team_id", "INT64", "Home team.", src="homeTeam.id", tags=_TEAM),
        _req("away_team_id", "INT64", "Away team.", src="awayTeam.id", tags=_TEAM),
        _c("home_team_abbrev", "STRING", "Short name of the home team.", src="homeTeam.abbrev",
           tags=["team"]),
        _c("away_team_abbrev", "STRING", "Short name of the away team.", src="awayTeam.abbrev",
           tags=["team"]),
        _c("venue_default_name", "STRING", "Venue in the default language.", src="venue.default",
           tags=["venue"]),
        _c("start_time_utc", "TIMESTAMP", "Start of the game in UTC.", src="startTimeUTC",
           tags=["temporal"]),
        _c("eastern_utc_offset", "STRING", "Offset of the Eastern zone on that day.",
           src="easternUTCOffset", tags=["temporal"], example="-04:00"),
        _c("venue_utc_offset", "STRING", "Offset at the venue.", src="venueUTCOffset",
           tags=["temporal"]),
        _c("game_state", "STRING", "Where the game is in its life.", src="gameState",
           tags=["status"], values=("FUT", "PRE", "LIVE", "CRIT", "FINAL", "OFF"),
           notes=("FINAL and OFF are finished games.",)),
        _c("final_period_type", "STRING", "Kind of the last period played.",
           src="gameOutcome.lastPeriodType", tags=["status"], values=PERIOD_TYPES),
        _c("home_score_final", "INT64", "Home goals at the end.", src="homeTeam.score",
           tags=["score_state"], domain=SCORES),
        _c("away_score_final", "INT64", "Away goals at the end.", src="awayTeam.score",
           tags=["score_state"], domain=SCORES),
        _c("is_shootout_decided", "BOOL", "Whether a shootout decided the game.",
           tags=["status"]),
        _ingested(),
    ),
    "game_date",
    ("season", "game_type"),
)

OFFICIALS = TableSpec(
    "game_officials",
    (
        _req("game_id", "INT64", "Game identifier.", src="id", tags=_KEY),
        _req("game_date", "DATE", "Day of the game in the score feed; partition column.",
             src="gameDate", tags=["temporal", "identifier"]),
        _req("role", "STRING", "Role with a number counted from 1 per role.",
             src="officials[].position", tags=["classification"],
             values=("REFEREE_1", "REFEREE_2", "LINESMAN_1", "LINESMAN_2")),
        _req("official_name", "STRING", "Name of the official.", src="officials[].default",
             tags=["person"]),
        _c("official_number", "STRING", "Sweater number of the official.",
           src="officials[].sweaterNumber", tags=["person"]),
        _ingested(),
    ),
    "game_date",
    ("game_id",),
)

BOXSCORE = TableSpec(
    "boxscore_stats",
    (
        _req("game_id", "INT64", "Game identifier.", src="id", tags=_KEY),
        _req("game_date", "DATE", "Day of the game; partition column.", src="gameDate",
             tags=["temporal", "identifier"]),
        _req("player_id", "INT64", "Player.", src="playerId", tags=_KEY),
        _req("team_id", "INT64", "Team the player dressed for.", src="(side teamId)", tags=_TEAM),
        _req("player_position_category", "STRING", "Skater or goalie.",
             tags=["classification"], values=("skater", "goalie")),
        _c("position_code", "STRING", "Position letter.", src="position",
           tags=["classification"], values=POSITIONS),
        _c("sweater_number", "INT64", "Number worn.", src="sweaterNumber", tags=["person"],
           domain=SWEATERS),
        _c("toi", "STRING", "Time on the ice as clock text.", src="toi", tags=["temporal"]),
        _count("goals", "Goals.", "goals"),
        _count("assists", "Assists.", "assists"),
        _count("points", "Goals and assists.", "points"),
        _count("plus_minus", "Goal balance while on the ice at even strength.", "plusMinus"),
        _count("pim", "Penalty minutes.", "pim"),
        _count("hits", "Hits made.", "hits"),
        _count("blocked_shots", "Shots blocked.", "blockedShots"),
        _count("shots", "Shots on goal.", "shots"),
        _count("faceoffs", "Faceoffs taken.", "faceoffs"),
        _c("faceoff_winning_pctg", "FLOAT64", "Share of faceoffs won.",
           src="faceoffWinningPctg", tags=["statistic"], domain=(0, 1)),
        _count("power_play_goals", "Goals with more players.", "powerPlayGoals"),
        _count("power_play_points", "Points with more players.", "powerPlayPoints"),
        _count("shorthanded_goals", "Goals with fewer players.", "shorthandedGoals"),
        _count("sh_points", "Points with fewer players.", "shPoints"),
        _c("power_play_toi", "STRING", "Time with more players, as clock text.",
           src="powerPlayToi", tags=["temporal"]),
        _c("shorthanded_toi", "STRING", "Time with fewer players, as clock text.",
           src="shorthandedToi", tags=["temporal"]),
        _count("shots_against", "Shots faced by the goalie.", "saveShotsAgainst"),
        _c("saves", "INT64", "Shots stopped by the goalie.", tags=["statistic"]),
        _c("save_pctg", "FLOAT64", "Share of shots stopped.", src="savePctg",
           tags=["statistic"], domain=(0, 1)),
        _count("goals_against", "Goals let in.", "goalsAgainst"),
        _count("even_strength_shots_against", "Even-strength shots against the goalie.",
               "evenStrengthShotsAgainst", notes=("Text such as 25/26 becomes NULL.",)),
        _count("power_play_shots_against", "Shots faced with fewer players.",
               "powerPlayShotsAgainst", notes=("Text such as 25/26 becomes NULL.",)),
        _count("shorthanded_shots_against", "Shots faced with more players.",
               "shorthandedShotsAgainst", notes=("Text such as 25/26 becomes NULL.",)),
        _count("even_strength_goals_against", "Goals let in at even strength.",
               "evenStrengthGoalsAgainst"),
        _count("power_play_goals_against", "Goals let in with fewer players.",
               "powerPlayGoalsAgainst"),
        _count("shorthanded_goals_against", "Goals let in with more players.",
               "shorthandedGoalsAgainst"),
        _ingested(),
    ),
    "game_date",
    ("player_id", "team_id"),
)

SHIFTS = TableSpec(
    "shifts",
    (
        _req("game_id", "INT64", "Game identifier.", src="gameId", tags=_KEY),
        _req("game_date", "DATE", "Day of the game in the score feed; partition column.",
             tags=["temporal", "identifier"]),
        _req("player_id", "INT64", "Player.", src="playerId", tags=_KEY),
        _req("team_id", "INT64", "Team of the player.", src="teamId", tags=_TEAM),
        _req("shift_number", "INT64", "Number of the shift for the player in the game.",
             src="shiftNumber", tags=["ordering"], domain=(1, 50)),
        _c("period", "INT64", "Period number.", src="period", tags=["temporal"], domain=PERIODS),
        _c("period_type", "STRING", "OT from period 4 on, else REG.", tags=["temporal"],
           values=PERIOD_TYPES),
        _c("start_in_period", "STRING", "Start as clock text.", src="startTime",
           tags=["temporal"]),
        _c("end_in_period", "STRING", "End as clock text.", src="endTime", tags=["temporal"]),
        _c("start_abs_seconds", "INT64", "Start in seconds since the start of the game.",
           tags=["temporal"], domain=GAME_SECONDS),
        _c("end_abs_seconds", "INT64", "End in seconds; the interval excludes it.",
           tags=["temporal"], domain=GAME_SECONDS,
           notes=("Compare start <= t < end.",)),
        _c("duration_seconds", "INT64", "End minus start.", tags=["temporal"], domain=(1, 600)),
        _ingested(),
    ),
    "game_date",
    ("player_id",),
)

STANDINGS = TableSpec(
    "standings",
    (
        _req("snapshot_date", "DATE", "Day the standings were asked for; partition column.",
             tags=["temporal", "identifier"]),
        _c("team_id", "INT64", "Team; usually NULL as the feed leaves it out.",
           src="teamAbbrev.id", tags=_TEAM,
           notes=("Resolve through the abbreviation in games.",)),
        _c("team_abbrev", "STRING", "Short name of the team.", src="teamAbbrev.default",
           tags=["team", "join_key"]),
        _c("team_name", "STRING", "Full name of the team.", src="teamName.default",
           tags=["team"]),
        _c("conference_name", "STRING", "Conference.", src="conferenceName", tags=["team"]),
        _c("division_name", "STRING", "Division.", src="divisionName", tags=["team"]),
        _count("games_played", "Games played so far.", "gamesPlayed", domain=(0, 100)),
        _count("wins", "Wins.", "wins"),
        _count("losses", "Losses in regulation.", "losses"),
        _count("ot_losses", "Losses after regulation.", "otLosses"),
        _count("points", "Two per win, one per loss after regulation.", "points"),
        _count("goal_for", "Goals scored.", "goalFor"),
        _count("goal_against", "Goals let in.", "goalAgainst"),
        _count("goal_differential", "Goals scored minus goals let in.", "goalDifferential"),
        _count("regulation_wins", "Wins in regulation.", "regulationWins"),
        _count("regulation_plus_ot_wins", "Wins without a shootout.", "regulationPlusOtWins"),
        _ingested(),
    ),
    "snapshot_date",
    ("conference_name", "division_name"),
)

PLAYERS = TableSpec(
    "dim_players",
    (
        _req("player_id", "INT64", "Player.", src="playerId", tags=_KEY),
        _c("first_name", "STRING", "First name.", src="firstName.default", tags=["person"]),
        _c("last_name", "STRING", "Last name.", src="lastName.default", tags=["person"]),
        _c("full_name", "STRING", "First and last name with a blank between.", tags=["person"]),
        _c("position_code", "STRING", "Position letter.", src="position",
           tags=["classification"], values=POSITIONS),
        _c("sweater_number", "INT64", "Number worn.", src="sweaterNumber", tags=["person"],
           domain=SWEATERS),
        _c("current_team_abbrev", "STRING", "Short name of the present team.",
           src="currentTeamAbbrev", tags=["team"]),
        _c("shoots_catches", "STRING", "Hand the player shoots or catches with.",
           src="shootsCatches", tags=["person"], values=("L", "R")),
        _c("birth_date", "DATE", "Date of birth.", src="birthDate", tags=["person"]),
        _c("birth_country", "STRING", "Country of birth as a three-letter code.",
           src="birthCountry", tags=["person"]),
        _c("height_inches", "INT64", "Height in inches.", src="heightInInches",
           tags=["person"], domain=(60, 84)),
        _c("weight_pounds", "INT64", "Weight in pounds.", src="weightInPounds",
           tags=["person"], domain=(140, 280)),
        _c("headshot_url", "STRING", "Address of the portrait.", src="headshot",
           tags=["person"]),
        _ingested(),
    ),
    key=("player_id",),
)

# Tables written together for one date chunk, in write order.
CHUNK_TABLES = {
    "games": GAMES,
    "officials": OFFICIALS,
    "boxscore": BOXSCORE,
    "shifts": SHIFTS,
    "plays": PLAYS,
    "standings": STANDINGS,
}
TABLES = {t.name: t for t in (*CHUNK_TABLES.values(), PLAYERS)}
