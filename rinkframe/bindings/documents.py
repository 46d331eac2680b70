"""Feed documents made from rows of the test tables, read back and flattened."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rinkframe.bindings.core import _words
from rinkframe.bindings.registry import query
from rinkframe.functions import clock, codes, coerce
from rinkframe.operators import dedupe, flatten, plays as play_ops, reconcile
from rinkframe.plans import players as player_plan
from rinkframe.sources import feeds
from rinkframe.specs import STANDINGS


def texts(rows: DataFrame, key: str, day: str, body: str) -> DataFrame:
    """Documents as JSON text, built from each row by a SQL struct.

    The rows are spread by key first, as reading JSON is dear and a small table is
    one split.
    """
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(spread, F.expr(key))
    return rows.selectExpr(
        f"cast({key} AS string) AS request_key", f"cast({day} AS date) AS feed_date",
        f"to_json({body}) AS payload")


def documents(rows: DataFrame, feed: str, key: str, day: str, body: str,
              items: tuple[str, ...] | None = None) -> DataFrame:
    """The same documents, parsed."""
    return feeds.parse_documents(texts(rows, key, day, body), feed, items=items)


def _plain(df: DataFrame) -> DataFrame:
    return _words(df.drop("ingested_at"))


# --- score, landing, work list ---------------------------------------------------

_TEAMS = """named_struct('id', o_custkey % 32 + 1, 'abbrev', concat('T', o_custkey % 32 + 1),
    'score', cast(floor(o_totalprice) AS bigint) % 8) AS homeTeam,
  named_struct('id', o_custkey % 31 + 1, 'abbrev', concat('T', o_custkey % 31 + 1),
    'score', cast(floor(o_totalprice) AS bigint) % 7) AS awayTeam"""
_GAME = f"""struct({{id}} AS id, {{season}} AS season, {{kind}} AS gameType, {{date}} AS gameDate,
  named_struct('default', o_orderpriority) AS venue,
  concat(cast(cast(o_orderdate AS date) AS string), 'T23:00:00Z') AS startTimeUTC,
  '-04:00' AS easternUTCOffset, '-05:00' AS venueUTCOffset,
  CASE o_orderstatus WHEN 'F' THEN 'FINAL' WHEN 'O' THEN 'OFF' ELSE 'LIVE' END AS gameState,
  {_TEAMS}{{more}})"""
_SEASON = "year(o_orderdate) * 10000L + year(o_orderdate) + 1"
_DATE = "cast(cast(o_orderdate AS date) AS string)"


def score_documents(view) -> DataFrame:
    """Two games per order: its own, and one that the next order lists as well."""
    first = _GAME.format(id="o_orderkey", season=_SEASON, kind="o_orderkey % 5", date=_DATE, more="")
    second = _GAME.format(id="o_orderkey + 1", season="0", kind="cast(NULL AS bigint)",
                          date="cast(NULL AS string)", more="")
    return documents(view("orders"), "score", "o_orderkey", "o_orderdate",
                     f"struct(array({first}, {second}) AS games)")


def landing_texts(orders: DataFrame, day: str = "o_orderdate") -> DataFrame:
    outcome = """, named_struct('lastPeriodType', CASE substr(o_orderpriority, 1, 1)
      WHEN '1' THEN 'REG' WHEN '2' THEN 'OT' WHEN '3' THEN 'SO' WHEN '4' THEN '' END)
      AS gameOutcome"""
    body = _GAME.format(id="o_orderkey", season=_SEASON, kind="o_orderkey % 5", date=_DATE,
                        more=outcome)
    return texts(orders, "o_orderkey", day, body)


def landing_documents(orders: DataFrame) -> DataFrame:
    return feeds.parse_documents(landing_texts(orders), "landing")


_GAME_COLUMNS_SQL = """
  'T' || (o_custkey % 32 + 1)::VARCHAR AS home_team_abbrev, o_custkey % 32 + 1 AS home_team_id,
  'T' || (o_custkey % 31 + 1)::VARCHAR AS away_team_abbrev, o_custkey % 31 + 1 AS away_team_id,
  o_orderpriority AS venue_default_name,
  (CAST(o_orderdate AS DATE) + INTERVAL 23 HOUR)::TIMESTAMP AS start_time_utc,
  '-04:00' AS eastern_utc_offset, '-05:00' AS venue_utc_offset,
  CASE o_orderstatus WHEN 'F' THEN 'FINAL' WHEN 'O' THEN 'OFF' ELSE 'LIVE' END AS game_state,
  CAST(floor(o_totalprice) AS BIGINT) % 8 AS home_score_final,
  CAST(floor(o_totalprice) AS BIGINT) % 7 AS away_score_final"""
_TYPE_SQL = "CASE o_orderkey % 5 WHEN 1 THEN 'PR' WHEN 3 THEN 'P' WHEN 4 THEN 'AS' ELSE 'R' END"

SCORE_SQL = f"""
score_rows AS (
  SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS feed_date, 0 AS pos,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS game_date, year(o_orderdate) AS season,
    {_TYPE_SQL} AS game_type, o_orderkey % 5 AS kind, {_GAME_COLUMNS_SQL} FROM orders
  UNION ALL BY NAME
  SELECT o_orderkey + 1 AS game_id, CAST(o_orderdate AS DATE) AS feed_date, 1 AS pos,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS game_date, 0 AS season,
    'R' AS game_type, NULL AS kind, {_GAME_COLUMNS_SQL} FROM orders
)"""
LANDING_SQL = f"""
landing_rows AS (
  SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS feed_date, 0 AS pos,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS game_date, year(o_orderdate) AS season,
    {_TYPE_SQL} AS game_type,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'REG' WHEN '2' THEN 'OT' WHEN '3' THEN 'SO'
      WHEN '4' THEN '' END AS final_period_type,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'false' WHEN '2' THEN 'false'
      WHEN '3' THEN 'true' END AS is_shootout_decided, {_GAME_COLUMNS_SQL}
  FROM orders
)"""


@query("prj5_games_from_score", f"""WITH {SCORE_SQL}
SELECT * EXCLUDE (feed_date, pos, kind), CAST(NULL AS VARCHAR) AS final_period_type,
  CAST(NULL AS VARCHAR) AS is_shootout_decided FROM score_rows""")
def games_from_score(view):
    return _plain(flatten.games_from_score(score_documents(view)))


@query("prj6_games_from_landing", f"""WITH {LANDING_SQL}
SELECT * EXCLUDE (feed_date, pos) FROM landing_rows""")
def games_from_landing(view):
    return _plain(flatten.games_from_landing(landing_documents(view("orders"))))


@query("win2_latest_games", f"""WITH {SCORE_SQL}, {LANDING_SQL},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY game_id
    ORDER BY source_rank DESC, feed_date DESC, pos DESC) AS k
  FROM (SELECT *, 0 AS source_rank FROM score_rows
        UNION ALL BY NAME SELECT *, 1 AS source_rank FROM landing_rows
          WHERE game_state = 'FINAL')
)
SELECT * EXCLUDE (feed_date, pos, kind, source_rank, k) FROM ranked WHERE k = 1""")
def latest_games(view):
    """Only finished games have a landing document, so both sources give rows."""
    finished = view("orders").where("o_orderstatus = 'F'")
    return _plain(dedupe.latest_games(
        flatten.games_from_score(score_documents(view), keep=("feed_date", "pos")),
        flatten.games_from_landing(landing_documents(finished), keep=("feed_date",))))


@query("win3_work_list", f"""WITH {SCORE_SQL}
SELECT game_id, game_date, CAST(feed_date AS VARCHAR) AS feed_date, pos
FROM (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY feed_date, pos) AS k
      FROM score_rows WHERE coalesce(kind, 0) <> 1)
WHERE k = 1""")
def work_list(view):
    return _words(dedupe.work_list(flatten.score_games(score_documents(view))))


@query("flt1_preseason_listed", f"""WITH {SCORE_SQL}
SELECT count(DISTINCT game_id) AS games FROM score_rows""")
def preseason_listed(view):
    games = dedupe.work_list(flatten.score_games(score_documents(view)), include_preseason=True)
    return games.agg(F.count("*").alias("games"))


# --- officials, standings, players -----------------------------------------------


@query("prj7_officials", """
WITH people AS (
  SELECT p_partkey, p_size, 'REFEREE_' AS kind, string_split(p_name, ' ') AS names FROM part
  UNION ALL
  SELECT p_partkey, p_size, 'LINESMAN_', [p_brand, p_type] FROM part WHERE p_size > 10
)
SELECT p_partkey AS game_id, '2024-10-08' AS game_date, kind || i::VARCHAR AS role,
  names[i] AS official_name, CASE WHEN kind = 'REFEREE_' THEN p_size::VARCHAR END AS official_number
FROM (SELECT *, unnest(range(1, len(names) + 1)) AS i FROM people)""")
def officials(view):
    body = """struct(struct(
        transform(split(p_name, ' '), n -> struct(n AS default, cast(p_size AS string) AS sweaterNumber))
          AS referees,
        CASE WHEN p_size > 10 THEN array(struct(p_brand AS default), struct(p_type AS default)) END
          AS linesmen) AS gameInfo)"""
    rail = documents(view("part"), "right_rail", "p_partkey", "'2024-10-08'", body)
    return _plain(flatten.officials(rail))


@query("prj11_standings", """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS snapshot_date,
  CASE WHEN o_custkey % 3 = 0 THEN o_custkey + 5 WHEN o_custkey % 3 = 1 THEN o_custkey + 7 END
    AS team_id,
  'T' || o_custkey::VARCHAR AS team_abbrev, o_orderpriority AS team_name,
  o_orderstatus AS conference_name, NULL::VARCHAR AS division_name,
  o_custkey % 82 AS games_played, o_custkey % 50 AS wins, o_custkey % 31 AS losses,
  NULL::BIGINT AS ot_losses, o_custkey % 110 AS points, o_custkey % 300 AS goal_for,
  o_custkey % 290 AS goal_against, o_custkey % 300 - o_custkey % 290 AS goal_differential,
  o_custkey % 40 AS regulation_wins, o_custkey % 45 AS regulation_plus_ot_wins
FROM orders""")
def standings(view):
    body = """struct(array(struct(
        named_struct('default', concat('T', o_custkey),
          'id', CASE WHEN o_custkey % 3 = 0 THEN o_custkey + 5 WHEN o_custkey % 3 = 1 THEN 0 END)
          AS teamAbbrev,
        named_struct('id', CASE WHEN o_custkey % 3 < 2 THEN o_custkey + 7 END) AS teamCommonName,
        named_struct('default', o_orderpriority) AS teamName, o_orderstatus AS conferenceName,
        o_custkey % 82 AS gamesPlayed, o_custkey % 50 AS wins, o_custkey % 31 AS losses,
        o_custkey % 110 AS points, o_custkey % 300 AS goalFor, o_custkey % 290 AS goalAgainst,
        o_custkey % 300 - o_custkey % 290 AS goalDifferential, o_custkey % 40 AS regulationWins,
        o_custkey % 45 AS regulationPlusOtWins)) AS standings)"""
    docs = documents(view("orders"), "standings", "cast(o_orderdate AS date)", "o_orderdate", body)
    return _plain(flatten.standings(docs))


def player_texts(view) -> DataFrame:
    """A document per customer with totals of two seasons; goals differ by nation."""
    total = """struct({season} AS season, '{league}' AS leagueAbbrev, {kind} AS gameTypeId,
        {goals} AS goals, c_nationkey AS assists)"""
    totals = ", ".join(
        total.format(season=s, league=g, kind=k, goals=n) for s, g, k, n in (
            (20212022, "NHL", 3, "1L"), (20212022, "AHL", 2, "2L"),
            (20212022, "NHL", 2, "c_custkey % 5 + c_nationkey % 2"), (20212022, "NHL", 2, "99L"),
            (20202021, "NHL", 2, "7L")))
    body = f"""struct(c_custkey AS playerId,
        named_struct('default', CASE WHEN c_acctbal > 0 THEN split_part(c_name, '#', 1) END) AS firstName,
        named_struct('default', CASE WHEN c_nationkey > 3 THEN split_part(c_name, '#', 2) ELSE '' END)
          AS lastName,
        substr(c_mktsegment, 1, 1) AS position, c_nationkey AS sweaterNumber,
        concat('T', c_nationkey) AS currentTeamAbbrev,
        concat('19', 70 + c_nationkey, '-02-', CASE WHEN c_nationkey > 20 THEN '30' ELSE '11' END)
          AS birthDate,
        'CAN' AS birthCountry, 60 + c_nationkey AS heightInInches,
        array({totals}) AS seasonTotals)"""
    return texts(view("customer"), "c_custkey", "NULL", body)


def player_documents(view) -> DataFrame:
    return feeds.parse_documents(player_texts(view), "player")


PLAYERS_SQL = """
SELECT *, CASE WHEN first_name IS NOT NULL AND last_name <> '' THEN first_name || ' ' || last_name
    WHEN first_name IS NOT NULL THEN first_name WHEN last_name <> '' THEN last_name END AS full_name
FROM (
  SELECT c_custkey AS player_id,
    CASE WHEN c_acctbal > 0 THEN split_part(c_name, '#', 1) END AS first_name,
    CASE WHEN c_nationkey > 3 THEN split_part(c_name, '#', 2) ELSE '' END AS last_name,
    substr(c_mktsegment, 1, 1) AS position_code, CAST(c_nationkey AS BIGINT) AS sweater_number,
    'T' || c_nationkey::VARCHAR AS current_team_abbrev, NULL::VARCHAR AS shoots_catches,
    CASE WHEN c_nationkey <= 20 THEN '19' || (70 + c_nationkey)::VARCHAR || '-02-11' END
      AS birth_date,
    'CAN' AS birth_country, CAST(60 + c_nationkey AS BIGINT) AS height_inches,
    NULL::BIGINT AS weight_pounds, NULL::VARCHAR AS headshot_url
  FROM customer)"""


@query("prj12_players", PLAYERS_SQL)
def players(view):
    return _plain(flatten.players(player_documents(view)))


@query("flt13_season_totals", """
SELECT c_custkey AS player_id, c_custkey % 5 + c_nationkey % 2 AS goals,
  CAST(c_nationkey AS BIGINT) AS assists, NULL::BIGINT AS points, NULL::BIGINT AS plus_minus,
  NULL::BIGINT AS pim, NULL::BIGINT AS hits, NULL::BIGINT AS blocked_shots, NULL::BIGINT AS shots
FROM customer""")
def season_totals(view):
    return flatten.season_totals(player_documents(view), clock.season_code(F.lit(2021)))


def _order_goals(view) -> DataFrame:
    """Every customer with orders is a scorer; a finished order is a goal."""
    return reconcile.scorer_goals(view("orders").selectExpr(
        "o_custkey AS scorer_id", "CASE WHEN o_orderstatus = 'F' THEN 'GOAL' ELSE 'SHOT' END AS event_type"))


def _player_sql() -> str:
    one = """SELECT 'player_season.{m}' AS name, count(*) FILTER ({bad}) AS violations,
      count(*) AS total, CAST(count(*) FILTER ({bad}) = 0 AS VARCHAR) AS passed,
      count(*) AS matched FROM pairs"""
    wrong = {"goals": "abs(goals - theirs) > 0", "assists": "nation > 0"}
    return f"""WITH goals AS (
      SELECT o_custkey AS player_id, count(*) FILTER (o_orderstatus = 'F') AS goals
      FROM orders GROUP BY o_custkey),
    pairs AS (
      SELECT g.goals, c_custkey % 5 + c_nationkey % 2 AS theirs, c_nationkey AS nation
      FROM goals g JOIN customer ON c_custkey = player_id)
    """ + " UNION ALL ".join(
        one.format(m=m, bad=wrong.get(m, "false")) for m in reconcile.PLAYER_METRICS)


@query("r2_player_season_all", _player_sql())
def player_season_all(view):
    return _words(reconcile.player_season(_order_goals(view), season_totals(view)))


@query("player_refresh_rows", """
SELECT c_custkey AS player_id, substr(c_mktsegment, 1, 1) AS position_code
FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def player_refresh_rows(view):
    ids = view("orders").where("o_orderstatus = 'F'").selectExpr("o_custkey AS player_id").distinct()
    return player_plan.player_rows(player_documents(view), ids).select("player_id", "position_code")


# --- boxscore --------------------------------------------------------------------

_SAVE_TEXT = """CASE l_returnflag
    WHEN 'A' THEN concat('"', l_linenumber, '/', cast(floor(l_quantity) AS bigint), '"')
    WHEN 'N' THEN cast(cast(floor(l_quantity) AS bigint) AS string)
    ELSE CASE l_linenumber WHEN 1 THEN '"x/5"' WHEN 2 THEN '"5/x"' WHEN 3 THEN '"7"'
      WHEN 4 THEN '"/"' WHEN 5 THEN 'null' WHEN 6 THEN '2.5' ELSE '"3/4/5"' END END"""


def boxscore_documents(view) -> DataFrame:
    """A document per line item: a home forward, an away defender and an away goalie."""
    skater = """struct({id} AS playerId, 'C' AS position, cast(l_linenumber AS bigint) AS sweaterNumber,
        concat(l_linenumber, ':00') AS toi, {goals} AS goals, l_discount AS faceoffWinningPctg,
        '1:00' AS powerPlayToi)"""
    goalie = f"""struct(l_partkey AS playerId, 'G' AS position, parse_json({_SAVE_TEXT}) AS saveShotsAgainst,
        CASE WHEN l_linestatus = 'F' AND l_linenumber < 3 THEN 40L END AS saves,
        CASE WHEN l_linestatus = 'F' AND l_linenumber = 2 THEN 50L END AS shotsAgainst,
        l_discount AS savePctg, 3L AS goalsAgainst,
        CASE WHEN l_linenumber < 4 THEN '25/26' ELSE cast(l_linenumber AS string) END
          AS evenStrengthShotsAgainst)"""
    home = skater.format(id="l_suppkey", goals="cast(l_linenumber AS bigint)")
    away = skater.format(id="l_partkey + 100000", goals="cast(NULL AS bigint)")
    body = f"""struct(l_orderkey AS id, cast(cast(l_shipdate AS date) AS string) AS gameDate,
        named_struct('id', 1L) AS homeTeam, named_struct('id', 2L) AS awayTeam,
        struct(struct(array({home}) AS forwards) AS homeTeam,
               struct(array({away}) AS defense, array({goalie}) AS goalies) AS awayTeam)
          AS playerByGameStats)"""
    return documents(view("lineitem"), "boxscore", "l_orderkey", "l_shipdate", body)


_BOX_REST = ", ".join(
    f"NULL::BIGINT AS {c}" for c in (
        "assists", "points", "plus_minus", "pim", "hits", "blocked_shots", "shots", "faceoffs",
        "power_play_goals", "power_play_points", "shorthanded_goals", "sh_points",
        "power_play_shots_against", "shorthanded_shots_against", "even_strength_goals_against",
        "power_play_goals_against", "shorthanded_goals_against"))


@query("prj8_boxscore", f"""
WITH base AS (
  SELECT *, CAST(floor(l_quantity) AS BIGINT) AS q,
    CASE WHEN l_linestatus = 'F' AND l_linenumber < 3 THEN 40 END AS own_saves,
    CASE WHEN l_linestatus = 'F' AND l_linenumber = 2 THEN 50 END AS own_shots,
    CASE WHEN l_returnflag = 'A' THEN l_linenumber WHEN l_returnflag = 'R' THEN
      CASE l_linenumber WHEN 2 THEN 5 WHEN 7 THEN 3 END END AS text_saves,
    CASE WHEN l_returnflag <> 'R' THEN CAST(floor(l_quantity) AS BIGINT) ELSE
      CASE l_linenumber WHEN 1 THEN 5 WHEN 6 THEN 2 WHEN 7 THEN 4 END END AS text_shots
  FROM lineitem
),
people AS (
  SELECT l_orderkey AS game_id, l_shipdate, l_suppkey AS player_id, 1 AS team_id,
    'skater' AS player_position_category, 'C' AS position_code,
    CAST(l_linenumber AS BIGINT) AS sweater_number, l_linenumber::VARCHAR || ':00' AS toi,
    CAST(l_linenumber AS BIGINT) AS goals, l_discount AS faceoff_winning_pctg,
    '1:00' AS power_play_toi, NULL::BIGINT AS saves, NULL::BIGINT AS shots_against,
    NULL::DOUBLE AS save_pctg, NULL::BIGINT AS goals_against,
    NULL::BIGINT AS even_strength_shots_against
  FROM base
  UNION ALL
  SELECT l_orderkey, l_shipdate, l_partkey + 100000, 2, 'skater', 'C', l_linenumber,
    l_linenumber::VARCHAR || ':00', NULL, l_discount, '1:00', NULL, NULL, NULL, NULL, NULL FROM base
  UNION ALL
  SELECT l_orderkey, l_shipdate, l_partkey, 2, 'goalie', 'G', NULL, NULL, NULL, NULL, NULL,
    coalesce(own_saves, text_saves),
    coalesce(own_shots, CASE WHEN l_returnflag = 'R' AND l_linenumber < 6
      AND coalesce(own_saves, text_saves) IS NULL THEN NULL ELSE text_shots END),
    l_discount, 3, CASE WHEN l_linenumber >= 4 THEN l_linenumber END
  FROM base
)
SELECT * EXCLUDE (l_shipdate), CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS game_date,
  NULL::VARCHAR AS shorthanded_toi, {_BOX_REST} FROM people""")
def boxscore(view):
    return _plain(flatten.boxscore(boxscore_documents(view)))


@query("r3_game_boxscore", """
WITH goals AS (
  SELECT l_suppkey AS player_id, count(*) FILTER (l_returnflag = 'A') AS goals
  FROM lineitem GROUP BY l_suppkey),
official AS (SELECT l_suppkey AS player_id, max(l_linenumber) AS n FROM lineitem GROUP BY l_suppkey)
SELECT 'game_boxscore.goals' AS name, count(*) FILTER (goals <> 700) AS violations,
  count(*) AS total, CAST(count(*) FILTER (goals <> 700) = 0 AS VARCHAR) AS passed,
  count(*) AS matched FROM goals JOIN official USING (player_id)""")
def game_boxscore(view):
    """One game of all line items; its boxscore gives every scorer 700 goals."""
    lines = view("lineitem")
    goals = reconcile.scorer_goals(lines.selectExpr(
        "l_suppkey AS scorer_id", "CASE WHEN l_returnflag = 'A' THEN 'GOAL' ELSE 'SHOT' END AS event_type"))
    body = """struct(1L AS id, struct(struct(array(
          struct(l_suppkey AS playerId, 1L AS goals), struct(l_suppkey AS playerId, 700L AS goals))
        AS forwards) AS homeTeam) AS playerByGameStats)"""
    docs = documents(lines, "boxscore", "l_orderkey", "l_shipdate", body, reconcile.BOXSCORE_ITEMS)
    return _words(reconcile.game_boxscore(goals, flatten.boxscore_players(docs)))


# --- shifts ----------------------------------------------------------------------


def shift_documents(view) -> DataFrame:
    """A document per line item with a sound shift and one that is often unreadable."""
    body = """struct(array(
        struct(cast(l_orderkey AS string) AS gameId, cast(l_partkey AS string) AS playerId,
          cast(l_suppkey % 3 AS string) AS teamId, cast(l_linenumber - 1 AS string) AS period,
          cast(l_linenumber AS string) AS shiftNumber, '0:30' AS startTime,
          concat(cast(floor(l_quantity) AS bigint) div 10, ':', lpad(cast(floor(l_quantity) AS bigint), 2, '0'))
            AS endTime),
        struct(cast(l_orderkey AS string) AS gameId,
          CASE l_returnflag WHEN 'A' THEN cast(l_partkey AS string) WHEN 'N' THEN 'nobody' END AS playerId,
          '2' AS teamId, CASE WHEN l_linenumber < 6 THEN '4' END AS period,
          CASE WHEN l_linestatus = 'F' THEN 'x' END AS shiftNumber, '1:00' AS startTime,
          CASE l_linenumber WHEN 1 THEN '0:59' WHEN 2 THEN '1:61' WHEN 3 THEN NULL ELSE '2:00' END
            AS endTime)) AS data)"""
    return documents(view("lineitem"), "shift_charts", "l_orderkey", "l_shipdate", body)


SHIFT_ROWS_SQL = """
raw AS (
  SELECT l_orderkey, l_shipdate, CAST(l_partkey AS BIGINT) AS player_id, l_suppkey % 3 AS team_id,
    CAST(l_linenumber AS BIGINT) AS shift_number, CAST(l_linenumber - 1 AS BIGINT) AS period,
    '0:30' AS start_text,
    (CAST(floor(l_quantity) AS BIGINT) // 10)::VARCHAR || ':'
      || lpad((CAST(floor(l_quantity) AS BIGINT))::VARCHAR, 2, '0') AS end_text,
    30 AS s, CAST(floor(l_quantity) AS BIGINT) // 10 * 60 + CAST(floor(l_quantity) AS BIGINT) AS e
  FROM lineitem
  UNION ALL
  SELECT l_orderkey, l_shipdate, CASE WHEN l_returnflag = 'A' THEN l_partkey END, 2,
    CASE WHEN l_linestatus = 'F' THEN -1 ELSE 0 END,
    CASE WHEN l_linenumber < 6 THEN 4 END, '1:00',
    CASE l_linenumber WHEN 1 THEN '0:59' WHEN 2 THEN '1:61' WHEN 3 THEN NULL ELSE '2:00' END,
    60, CASE l_linenumber WHEN 1 THEN 59 WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE 120 END
  FROM lineitem
)"""


@query("prj9_shifts", f"""WITH {SHIFT_ROWS_SQL}
SELECT l_orderkey AS game_id, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS game_date, player_id,
  team_id, greatest(shift_number, 0) AS shift_number, period,
  CASE WHEN period >= 4 THEN 'OT' ELSE 'REG' END AS period_type, start_text AS start_in_period,
  end_text AS end_in_period, (period - 1) * 1200 + s AS start_abs_seconds,
  (period - 1) * 1200 + e AS end_abs_seconds, e - s AS duration_seconds
FROM raw WHERE period IS NOT NULL AND e > s""")
def shift_rows(view):
    return _plain(flatten.shifts(shift_documents(view)))


@query("prj10_merge_shifts", f"""WITH {SHIFT_ROWS_SQL}
SELECT l_orderkey AS game_id, player_id, team_id, period, shift_number,
  (period - 1) * 1200 + s AS start_abs_seconds, (period - 1) * 1200 + e AS end_abs_seconds
FROM raw WHERE period >= 1 AND e IS NOT NULL AND player_id IS NOT NULL AND shift_number >= 0""")
def merge_shift_rows(view):
    return flatten.merge_shifts(shift_documents(view))


# --- plays -----------------------------------------------------------------------


def play_documents(view) -> DataFrame:
    """A document per event with three plays, and a landing header beside it."""
    play = """struct({no} AS eventId, {no} * 10 AS sortOrder, {key} AS typeDescKey,
        struct({period} AS number, {kind} AS periodType) AS periodDescriptor,
        {time} AS timeInPeriod, '15:00' AS timeRemaining, '1551' AS situationCode,
        {details} AS details)"""
    wide = """struct(value - 60 AS xCoord, value / 2 AS yCoord, substr('ODX', {n}, 1) AS zoneCode,
        user_id % 2 AS eventOwnerTeamId, user_id AS shootingPlayerId, user_id + 1 AS goalieInNetId,
        user_id + 2 AS scoringPlayerId, user_id + 3 AS assist1PlayerId, user_id + 4 AS assist2PlayerId,
        user_id + 5 AS hittingPlayerId, user_id + 6 AS hitteePlayerId, user_id + 7 AS winningPlayerId,
        user_id + 8 AS losingPlayerId, user_id + 9 AS drawnByPlayerId, user_id + 10 AS servedByPlayerId,
        user_id + 11 AS committedByPlayerId, user_id + 12 AS blockingPlayerId, user_id + 13 AS playerId,
        event_type AS shotType, 2L AS duration, CASE WHEN user_id % 3 = 0 THEN 'MIN' ELSE 'XX' END
          AS typeCode, 'tripping' AS descKey, user_id % 4 AS homeScore, user_id % 3 AS awayScore)"""
    plays = ", ".join((
        play.format(no="1L", key="'giveaway'", period="1", kind="'REG'", time="'0:10'",
                    details=wide.format(n=1)),
        play.format(no="2L", key="'goal'", period="cast(NULL AS int)", kind="'REG'", time="'9:99'",
                    details=wide.format(n=2)),
        play.format(no="3L", key="event_type", period="5", kind="'SO'", time="cast(NULL AS string)",
                    details=wide.format(n=3)),
    ))
    own = "CASE WHEN event_type <> 'view' THEN {} END"
    body = f"""struct({own.format('event_id')} AS id,
        CASE event_type WHEN 'click' THEN '' ELSE '2024-10-08' END AS gameDate,
        {own.format('20242025L')} AS season, CASE WHEN event_type = 'error' THEN 0L ELSE 2L END AS gameType,
        {own.format("named_struct('id', 7L, 'abbrev', 'OWN')")} AS homeTeam,
        {own.format("named_struct('id', 8L)")} AS awayTeam, array({plays}) AS plays)"""
    docs = documents(view("events"), "play_by_play", "event_id", "ts", body)
    return docs.withColumn("landing", F.expr("""named_struct('id', cast(request_key AS bigint),
        'gameDate', '2024-11-11', 'season', 20192020L, 'gameType', 3,
        'homeTeam', named_struct('id', 17L, 'abbrev', 'LH'),
        'awayTeam', named_struct('id', 18L, 'abbrev', 'LA'))"""))


_ROLE_SQL = ", ".join(
    f"user_id + {i} AS {c}" for i, c in enumerate(play_ops.ROLES))


@query("prj1_play_rows", f"""
WITH picks AS (SELECT *, unnest([1, 2, 3]) AS n FROM events)
SELECT event_id AS game_id,
  CASE WHEN event_type = 'click' THEN '2024-11-11' ELSE '2024-10-08' END AS game_date,
  CASE WHEN event_type = 'view' THEN 2019 ELSE 2024 END AS season,
  CASE WHEN event_type = 'error' THEN 'P' ELSE 'R' END AS game_type,
  CASE WHEN event_type = 'view' THEN 17 ELSE 7 END AS home_team_id,
  CASE WHEN event_type = 'view' THEN 18 ELSE 8 END AS away_team_id,
  CASE WHEN event_type = 'view' THEN 'LH' ELSE 'OWN' END AS home_team_abbrev,
  CASE WHEN event_type = 'view' THEN 'LA' END AS away_team_abbrev,
  n - 1 AS pos, n AS event_id, n * 10 AS sort_order,
  CASE n WHEN 1 THEN 1 WHEN 3 THEN 5 END AS period, CASE n WHEN 3 THEN 'SO' ELSE 'REG' END AS period_type,
  CASE n WHEN 1 THEN '0:10' WHEN 2 THEN '9:99' END AS time_in_period, '15:00' AS time_remaining,
  CASE n WHEN 1 THEN 10 END AS event_abs_seconds,
  CASE n WHEN 1 THEN 'GIVEAWAY' WHEN 2 THEN 'GOAL' END AS event_type,
  CASE n WHEN 1 THEN 'giveaway' WHEN 2 THEN 'goal' ELSE event_type END AS event_type_desc,
  '1551' AS situation_code, value - 60 AS x_coord, value / 2 AS y_coord,
  substr('ODX', n, 1) AS zone_code,
  CASE n WHEN 1 THEN 'offensive' WHEN 2 THEN 'defensive' END AS zone_descriptor,
  user_id % 2 AS event_owner_team_id, {_ROLE_SQL},
  CASE n WHEN 1 THEN user_id + 13 END AS committed_by_id, event_type AS shot_type,
  2 AS penalty_minutes, CASE WHEN user_id % 3 = 0 THEN 'MIN' END AS penalty_severity,
  CASE WHEN user_id % 3 = 0 THEN 'MIN' ELSE 'XX' END AS penalty_type_code,
  'tripping' AS penalty_type_desc, user_id % 4 AS home_score, user_id % 3 AS away_score,
  5 AS home_skaters_on_ice, 5 AS away_skaters_on_ice, 'true' AS home_goalie_on_ice,
  'true' AS away_goalie_on_ice
FROM picks""")
def play_rows(view):
    return _words(play_ops.play_rows(play_documents(view)))


# --- types -----------------------------------------------------------------------


@query("fn25_coerced_types", """
SELECT CAST(TRY_CAST(CASE l_linenumber WHEN 1 THEN '2024-02-30' ELSE '2024-02-1' || l_linenumber::VARCHAR END
    AS DATE) AS VARCHAR) AS snapshot_date,
  CASE WHEN l_returnflag = 'A' THEN l_orderkey END AS team_id,
  l_returnflag AS team_abbrev, CAST(l_linenumber AS BIGINT) AS wins, l_partkey AS losses
FROM lineitem""")
def coerced_types(view):
    loose = view("lineitem").selectExpr(
        "CASE l_linenumber WHEN 1 THEN '2024-02-30' ELSE concat('2024-02-1', l_linenumber) END AS snapshot_date",
        """CASE l_returnflag WHEN 'A' THEN cast(l_orderkey AS string) WHEN 'N' THEN '25/26'
           ELSE 'x' END AS team_id""",
        "l_returnflag AS team_abbrev", "l_linenumber AS wins", "concat(' ', l_partkey) AS losses")
    return _plain(coerce.conform(loose, STANDINGS)).select(
        "snapshot_date", "team_id", "team_abbrev", "wins", "losses")


@query("fn12_snake_case_columns", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS plus_minus_k FROM events""")
def snake_case_columns(view):
    return view("events").select(
        F.col("event_id").alias(codes.snake_case("eventId")),
        F.get_json_object("props", "$.k").try_cast("bigint").alias(codes.snake_case("plusMinusK")))
