"""Discovery, replacement of table parts, chunk plans and whole chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rinkframe import session
from rinkframe.bindings.core import _words
from rinkframe.bindings.documents import documents
from rinkframe.bindings.registry import query
from rinkframe.bindings.views import GAMES_SQL
from rinkframe.operators import checks, chunks, discovery, replace
from rinkframe.plans import chunk as chunk_plan
from rinkframe.sources import feeds, tables
from rinkframe.specs import GAMES, TableSpec

# --- player ids ------------------------------------------------------------------

_ROLES_SQL = [
    "CASE WHEN l_returnflag <> 'N' THEN l_partkey END", "l_suppkey", "NULL",
    "CASE WHEN l_linenumber > 3 THEN l_partkey + 1 END", "l_suppkey + l_linenumber",
    "l_linenumber", "NULL", "l_partkey * 2", "NULL", "l_suppkey", "l_suppkey", "l_partkey",
    "NULL", "CASE WHEN l_returnflag = 'A' THEN l_orderkey END",
]


def _role_table(view) -> DataFrame:
    """Line items with the 14 role columns and the two arrays of plays."""
    roles = [f"cast({e} AS bigint) AS {c}" for e, c in zip(_ROLES_SQL, discovery.ID_COLUMNS)]
    return view("lineitem").selectExpr(
        *roles, "array(l_partkey + 7, l_suppkey) AS home_on_ice_ids",
        "CASE WHEN l_linenumber > 1 THEN array(l_orderkey % 977) END AS away_on_ice_ids")


IDS_SQL = "ids AS (SELECT DISTINCT player_id FROM (" + " UNION ALL ".join(
    [f"SELECT CAST({e} AS BIGINT) AS player_id FROM lineitem" for e in _ROLES_SQL]
    + ["SELECT unnest([l_partkey + 7, l_suppkey]) FROM lineitem",
       "SELECT l_orderkey % 977 FROM lineitem WHERE l_linenumber > 1"]
) + ") WHERE player_id IS NOT NULL)"


@query("set1_player_ids", f"WITH {IDS_SQL} SELECT player_id FROM ids")
def player_ids(view):
    return discovery.player_ids(_role_table(view))


@query("join5_missing_players", f"""WITH {IDS_SQL}
SELECT i.player_id FROM ids i LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) c
  ON c.c_custkey = i.player_id WHERE c.c_custkey IS NULL""")
def missing_players(view):
    known = view("customer").where("c_acctbal > 0").selectExpr("c_custkey AS player_id")
    return discovery.missing_players(discovery.player_ids(_role_table(view)), known)


@query("src13_id_list", """
SELECT l_orderkey, l_linenumber, unnest([l_partkey, l_suppkey]) AS id FROM lineitem""")
def id_list(view):
    text = F.expr("concat(' ', l_partkey, ', ,', l_suppkey, ',')")
    return view("lineitem").select("l_orderkey", "l_linenumber", feeds.id_list(text).alias("id"))


# --- replacing parts of a table --------------------------------------------------

_ORDERS = "o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day"


def _orders(view) -> DataFrame:
    return view("orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus",
        "CASE WHEN o_orderpriority <> '5-LOW' THEN cast(o_orderdate AS date) END AS day")


_DAYS = """days AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
    CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS day FROM orders
)"""
_OUT = "o_orderkey, o_custkey, o_orderstatus, CAST(day AS VARCHAR) AS day"


@query("snk2_replace_window", f"""WITH {_DAYS}
SELECT {_OUT} FROM days
WHERE NOT coalesce(day BETWEEN DATE '1997-03-01' AND DATE '1997-08-31', false)
UNION ALL
SELECT -o_orderkey, o_custkey, 'N', CAST(day AS VARCHAR) FROM days
WHERE day BETWEEN DATE '1997-05-01' AND DATE '1997-10-31' AND o_orderstatus <> 'P'""")
def replace_window(view):
    """New rows cover part of the window and reach beyond its end."""
    new = _orders(view).where(
        "day BETWEEN DATE'1997-05-01' AND DATE'1997-10-31' AND o_orderstatus <> 'P'"
    ).selectExpr("-o_orderkey AS o_orderkey", "o_custkey", "'N' AS o_orderstatus", "day")
    return _words(replace.replace_window(_orders(view), new, "day", "1997-03-01", "1997-08-31"))


@query("snk2_replace_window_empty", f"WITH {_DAYS} SELECT {_OUT} FROM days")
def replace_window_empty(view):
    """Without new rows the window keeps its old ones."""
    none = _orders(view).where("o_orderstatus = 'no such status'")
    return _words(replace.replace_window(_orders(view), none, "day", "1997-03-01", "1997-08-31"))


_CUSTOMERS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


@query("snk4_upsert_players", """
SELECT c_custkey, 'new ' || c_name AS c_name, c_nationkey + 1 AS c_nationkey, c_mktsegment
FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT c_custkey + 1000000000, c_name, c_nationkey, 'ADDED' FROM customer WHERE c_acctbal < 0
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def upsert_players(view):
    target = view("customer").select(*_CUSTOMERS)
    changed = target.where("c_mktsegment = 'BUILDING'").selectExpr(
        "c_custkey", "concat('new ', c_name) AS c_name", "c_nationkey + 1 AS c_nationkey",
        "c_mktsegment")
    added = view("customer").where("c_acctbal < 0").selectExpr(
        "c_custkey + 1000000000 AS c_custkey", "c_name", "c_nationkey", "'ADDED' AS c_mktsegment")
    return replace.upsert(target, changed.unionByName(added), ["c_custkey"])


@query("snk8_replace_by_key", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
UNION ALL
SELECT -c_custkey, c_custkey, 'F', '1-URGENT' FROM customer""")
def replace_by_key(view):
    target = view("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    new = view("customer").selectExpr(
        "-c_custkey AS o_orderkey", "c_custkey AS o_custkey", "'F' AS o_orderstatus",
        "'1-URGENT' AS o_orderpriority")
    return replace.replace_by_key(
        target, new, {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"})


# --- chunks ----------------------------------------------------------------------

_BOUNDS_SQL = """bounds AS (
  SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e
  FROM orders GROUP BY o_custkey
)"""


def _bounds(view) -> DataFrame:
    """First and last order day of every customer."""
    return view("orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("start"),
        F.max("o_orderdate").cast("date").alias("end"))


def _chunks_sql(unit: str) -> str:
    return f"""chunks AS (
  SELECT greatest(s, first) AS chunk_start,
    least(e, CAST(first + INTERVAL 1 {unit} - INTERVAL 1 DAY AS DATE)) AS chunk_end
  FROM (SELECT s, e, CAST(unnest(generate_series(date_trunc('{unit}', s)::TIMESTAMP,
          date_trunc('{unit}', e)::TIMESTAMP, INTERVAL 1 {unit})) AS DATE) AS first FROM bounds)
)"""


_CHUNK_OUT = "CAST(chunk_start AS VARCHAR) AS chunk_start, CAST(chunk_end AS VARCHAR) AS chunk_end"


@query("chunks_by_month", f"WITH {_BOUNDS_SQL}, {_chunks_sql('month')} SELECT {_CHUNK_OUT} FROM chunks")
def month_chunks(view):
    return _words(chunks.plan_chunks(_bounds(view), "month"))


@query("chunks_by_year", f"WITH {_BOUNDS_SQL}, {_chunks_sql('year')} SELECT {_CHUNK_OUT} FROM chunks")
def year_chunks(view):
    return _words(chunks.plan_chunks(_bounds(view), "year"))


@query("chunks_as_range", f"""WITH {_BOUNDS_SQL}
SELECT CAST(s AS VARCHAR) AS chunk_start, CAST(e AS VARCHAR) AS chunk_end FROM bounds""")
def range_chunks(view):
    return _words(chunks.plan_chunks(_bounds(view), "range"))


_RUNS_SQL = """runs AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS chunk_start,
    CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS chunk_end,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 495000 THEN 'success'
         WHEN o_orderpriority = '5-LOW' AND o_totalprice > 497000 THEN 'empty' ELSE 'failed' END
      AS status
  FROM orders
)"""


def _runs(view) -> DataFrame:
    """A run log with one attempt of a calendar month per order."""
    return view("orders").selectExpr(
        "cast(trunc(o_orderdate, 'MM') AS date) AS chunk_start",
        "last_day(o_orderdate) AS chunk_end",
        """CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 495000 THEN 'success'
           WHEN o_orderpriority = '5-LOW' AND o_totalprice > 497000 THEN 'empty' ELSE 'failed' END
           AS status""")


@query("flt11_completed_chunks", f"""WITH {_RUNS_SQL}
SELECT DISTINCT {_CHUNK_OUT} FROM runs WHERE status IN ('success', 'empty')""")
def completed_chunks(view):
    return _words(tables.completed_chunks(_runs(view)))


@query("join9_pending_chunks", f"""WITH {_BOUNDS_SQL}, {_chunks_sql('month')}, {_RUNS_SQL}
SELECT {_CHUNK_OUT} FROM chunks c WHERE NOT EXISTS (
  SELECT 1 FROM runs r WHERE r.status IN ('success', 'empty')
  AND r.chunk_start = c.chunk_start AND r.chunk_end = c.chunk_end)""")
def pending_chunks(view):
    planned = chunks.plan_chunks(_bounds(view), "month")
    return _words(chunks.pending_chunks(planned, tables.completed_chunks(_runs(view))))


@query("src12_dates_of_chunks", f"""WITH {_BOUNDS_SQL}
SELECT o_custkey, count(*) AS days FROM (
  SELECT o_custkey, unnest(generate_series(s::TIMESTAMP, e::TIMESTAMP, INTERVAL 1 DAY)) FROM bounds)
GROUP BY o_custkey""")
def dates_of_chunks(view):
    days = _bounds(view).select("o_custkey", feeds.dates_between(F.col("start"), F.col("end")))
    return days.groupBy("o_custkey").agg(F.count("*").alias("days"))


# --- declared domains ------------------------------------------------------------

_DECLARED = TableSpec("games", tuple(
    c for c in GAMES.columns if c.name in ("game_id", "game_date", "season", "home_team_id",
                                           "game_state", "home_score_final", "game_type")))


@query("q9_conformance", f"""WITH {GAMES_SQL},
g AS (SELECT games.*, o_custkey % 23 AS home_score_final,
  CASE WHEN o_orderpriority <> '5-LOW' THEN substr(o_orderpriority, 3, 1) END AS game_type,
  CASE WHEN o_totalprice > 100000 THEN game_date END AS day FROM games JOIN orders ON o_orderkey = game_id)
SELECT name, v AS violations, n AS total, CAST(v = 0 AS VARCHAR) AS passed FROM (
  SELECT 'game_id.required' AS name, 0 AS v, count(*) AS n FROM g UNION ALL
  SELECT 'game_date.required', count(*) FILTER (day IS NULL), count(*) FROM g UNION ALL
  SELECT 'season.required', 0, count(*) FROM g UNION ALL
  SELECT 'season.range', 0, count(*) FROM g UNION ALL
  SELECT 'game_type.values', count(*) FILTER (game_type NOT IN ('PR', 'R', 'P', 'AS')), count(game_type)
    FROM g UNION ALL
  SELECT 'home_team_id.required', 0, count(*) FROM g UNION ALL
  SELECT 'game_state.values', 0, count(*) FROM g UNION ALL
  SELECT 'home_score_final.range', count(*) FILTER (home_score_final > 20), count(*) FROM g)""")
def conformance(view):
    games = view("orders").selectExpr(
        "o_orderkey AS game_id", "2020 + o_orderkey % 3 AS season",
        "o_orderkey % 25 AS home_team_id",
        "CASE WHEN o_totalprice > 100000 THEN cast(o_orderdate AS date) END AS game_date",
        "CASE o_orderstatus WHEN 'F' THEN 'FINAL' WHEN 'O' THEN 'OFF' ELSE 'LIVE' END AS game_state",
        "o_custkey % 23 AS home_score_final",
        "CASE WHEN o_orderpriority <> '5-LOW' THEN substr(o_orderpriority, 3, 1) END AS game_type")
    return _words(checks.conformance(games, _DECLARED))


# --- whole chunks ----------------------------------------------------------------


def chunk_documents(view) -> dict[str, DataFrame]:
    """All feeds of a chunk: every event is a game with three plays and two shifts.

    What is wrong with a game depends on its event type and value: errors miss
    a document, have a bad clock, no landing team, no boxscore player or no
    shift team, in bands of the value.
    """
    events = view("events")

    def docs(feed: str, body: str, rows: DataFrame = events) -> DataFrame:
        return documents(rows, feed, "event_id", "ts", body)

    day = "cast(cast(ts AS date) AS string)"
    teams = """named_struct('id', 1L, 'abbrev', 'HOM', 'score', 3L) AS homeTeam,
        named_struct('id', CASE WHEN event_type = 'error' AND value BETWEEN 10 AND 30 AND {broken}
          THEN NULL ELSE 2L END, 'abbrev', 'AWY', 'score', 1L) AS awayTeam"""
    game = f"""event_id AS id, 20242025L AS season, {day} AS gameDate,
        CASE WHEN event_type = 'view' AND value > 100 THEN 1 ELSE 2 END AS gameType,
        'OFF' AS gameState, {teams}"""
    play = """struct({no} AS eventId, 'hit' AS typeDescKey,
        struct(1 AS number, 'REG' AS periodType) AS periodDescriptor, {time} AS timeInPeriod,
        '1551' AS situationCode, struct({home} AS homeScore, {away} AS awayScore) AS details)"""
    plays = ", ".join((
        play.format(no="1L", time="'0:10'", home="user_id % 3", away="cast(NULL AS bigint)"),
        play.format(no="2L", away="user_id % 2", home="cast(NULL AS bigint)",
                    time="CASE WHEN event_type = 'error' AND value < 10 THEN '5:60' ELSE '1:00' END"),
        play.format(no="3L", time="cast(NULL AS string)", home="0L", away="cast(NULL AS bigint)"),
    ))
    shift = """struct(cast(event_id AS string) AS gameId, cast({player} AS string) AS playerId,
        {team} AS teamId, '1' AS period, '0:00' AS startTime, {end} AS endTime)"""
    shifts = ", ".join((
        shift.format(player="user_id", team="'1'", end="concat(cast(floor(value) AS bigint) % 20, ':00')"),
        shift.format(player="user_id + 1", end="'1:00'",
                     team="CASE WHEN event_type = 'error' AND value BETWEEN 60 AND 100 THEN NULL ELSE '2' END"),
    ))
    forward = """struct(CASE WHEN event_type = 'error' AND value BETWEEN 30 AND 60 THEN NULL
        ELSE user_id END AS playerId, user_id % 4 AS goals)"""
    return {
        "score": docs("score", f"struct(array(struct({game.format(broken='false')})) AS games)"),
        "play_by_play": docs("play_by_play", f"struct({game.format(broken='false')}, array({plays}) AS plays)"),
        "shift_charts": docs(
            "shift_charts", f"struct(CASE WHEN event_type <> 'click' THEN array({shifts}) END AS data)"),
        "boxscore": docs("boxscore", f"""struct({game.format(broken='false')},
            struct(struct(array({forward}) AS forwards) AS homeTeam) AS playerByGameStats)"""),
        "right_rail": docs(
            "right_rail", "struct(struct(array(struct(event_type AS default)) AS referees) AS gameInfo)",
            events.where("NOT (event_type = 'error' AND value > 200)")),
        "landing": docs("landing", f"""struct({game.format(broken='true')},
            named_struct('lastPeriodType', 'SO') AS gameOutcome)"""),
        "standings": documents(events, "standings", "cast(ts AS date)", "ts",
                               "struct(array(struct(event_id AS wins)) AS standings)"),
    }


# Index of the failing stage as in ``chunk.STAGES``: fetch, plays, games, -, boxscore, shifts.
CHUNK_SQL = """
listed AS (
  SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
    CASE WHEN event_type <> 'error' THEN 9 WHEN value > 200 THEN 0 WHEN value < 10 THEN 1
      WHEN value BETWEEN 10 AND 30 THEN 2 WHEN value BETWEEN 30 AND 60 THEN 4
      WHEN value BETWEEN 60 AND 100 THEN 5 ELSE 9 END AS failed
  FROM events WHERE NOT (event_type = 'view' AND value > 100)
),
play_out AS (
  SELECT event_id AS game_id, n AS event_id, day AS game_date,
    CASE WHEN n > 1 THEN user_id % 3 ELSE 0 END AS home_score_before,
    CASE n WHEN 3 THEN 0 ELSE user_id % 3 END AS home_score_after,
    CASE WHEN n > 2 THEN user_id % 2 ELSE 0 END AS away_score_before,
    CASE n WHEN 1 THEN 0 ELSE user_id % 2 END AS away_score_after,
    CASE WHEN n < 3 AND event_type <> 'click'
      AND (CASE n WHEN 1 THEN 10 ELSE 60 END) < CAST(floor(value) AS BIGINT) % 20 * 60
      THEN user_id::VARCHAR ELSE '' END AS home_on_ice_ids,
    CASE WHEN n = 1 AND event_type <> 'click'
      AND NOT (event_type = 'error' AND value BETWEEN 60 AND 100)
      THEN (user_id + 1)::VARCHAR ELSE '' END AS away_on_ice_ids,
    CASE WHEN event_type <> 'click' THEN 'FULL' ELSE 'NO_SHIFTS' END AS source_quality,
    CASE WHEN event_type <> 'click' THEN 'EV' END AS strength_state
  FROM (SELECT *, unnest([1, 2, 3]) AS n FROM listed) WHERE failed > 1
)"""


def _chunk(view) -> chunk_plan.ChunkPlan:
    """Plan of one chunk; what several of its tables read is computed once."""
    return chunk_plan.plan_chunk(
        chunk_documents(view), keep=lambda df, _name: session.cut_lineage(df))


@query("sync_plays", f"WITH {CHUNK_SQL} SELECT * FROM play_out")
def sync_plays(view):
    return _words(_chunk(view).table("plays").select(
        "game_id", "event_id", "game_date", "home_score_before", "home_score_after",
        "away_score_before", "away_score_after",
        F.array_join("home_on_ice_ids", ",").alias("home_on_ice_ids"),
        F.array_join("away_on_ice_ids", ",").alias("away_on_ice_ids"), "source_quality",
        "strength_state"))


@query("sync_games", f"""WITH {CHUNK_SQL}
SELECT e.event_id AS game_id, CASE WHEN coalesce(l.failed, 0) > 2 THEN 'SO' END AS final_period_type,
  CASE WHEN e.event_type = 'view' AND e.value > 100 THEN 'PR' ELSE 'R' END AS game_type
FROM events e LEFT JOIN listed l ON l.event_id = e.event_id""")
def sync_games(view):
    return _chunk(view).table("games").select("game_id", "final_period_type", "game_type")


_STAGE_SQL = {1: "plays", 2: "games", 3: "officials", 4: "boxscore", 5: "shifts"}


@query("sync_row_counts", f"""WITH {CHUNK_SQL}
SELECT 'games' AS "table", count(*) AS rows FROM events UNION ALL
SELECT 'officials', count(*) FROM listed WHERE failed > 3 UNION ALL
SELECT 'boxscore', count(*) FROM listed WHERE failed > 4 UNION ALL
SELECT 'shifts', CAST(coalesce(sum(1 + CASE WHEN CAST(floor(value) AS BIGINT) % 20 > 0 THEN 1 ELSE 0 END), 0)
  AS BIGINT) FROM listed WHERE failed > 5 AND event_type <> 'click' UNION ALL
SELECT 'plays', count(*) FROM play_out UNION ALL
SELECT 'standings', count(*) FROM events""")
def sync_row_counts(view):
    """Rows each table of the chunk would get."""
    return _chunk(view).row_counts()


@query("sync_skipped_games", f"""WITH {CHUNK_SQL}
SELECT event_id AS game_id, day AS game_date,
  ['fetch', 'plays', 'games', 'officials', 'boxscore', 'shifts'][failed + 1] AS stage
FROM listed WHERE failed < 9""")
def sync_skipped_games(view):
    return _chunk(view).skipped.select("game_id", "game_date", "stage")
