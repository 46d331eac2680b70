"""Test tables shaped as game data.

Each function has its SQL twin in this file. A game is 40 consecutive events, so
games stay the same size however large the table gets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rinkframe.functions import clock

# --- plays and shifts from events ------------------------------------------------

PLAYS_SQL = """
e AS (
  SELECT *, event_id // 40 AS game_id,
    event_id % 40 * 120 + CAST(floor(value) AS BIGINT) % 120 AS second,
    CAST(floor(value) AS BIGINT) AS whole, user_id % 3 + 1 AS team
  FROM events
),
plays AS (
  SELECT event_id, game_id, CAST(ts AS DATE) AS game_date, 2020 + game_id % 3 AS season,
    second // 1200 + 1 AS period,
    CASE WHEN event_type = 'view' AND value < 2 THEN NULL
         WHEN second < 3600 THEN 'REG' WHEN event_type = 'error' THEN 'SO' ELSE 'OT' END
      AS period_type,
    CASE WHEN event_type = 'error' AND value < 5 THEN NULL
         ELSE (second % 1200 // 60)::VARCHAR || ':' || lpad((second % 60)::VARCHAR, 2, '0') END
      AS time_in_period,
    CASE WHEN event_type = 'error' AND value < 5 THEN NULL ELSE second END AS event_abs_seconds,
    CASE event_type WHEN 'purchase' THEN 'GOAL' WHEN 'click' THEN 'SHOT'
      WHEN 'view' THEN 'FACEOFF' WHEN 'signup' THEN 'HIT' ELSE 'STOPPAGE' END AS event_type,
    CASE WHEN event_type <> 'view' THEN team END AS event_owner_team_id,
    CASE WHEN event_type IN ('click', 'purchase') THEN 100 + user_id % 12 END AS shooter_id,
    CASE WHEN event_type = 'purchase' THEN 100 + user_id % 12 END AS scorer_id,
    CAST(1 AS BIGINT) AS home_team_id, CAST(2 AS BIGINT) AS away_team_id,
    CASE WHEN event_type = 'purchase' AND team <> 2 THEN whole % 6 END AS home_score,
    CASE WHEN event_type = 'purchase' AND team <> 1 THEN whole % 5 END AS away_score,
    CASE WHEN event_type <> 'view' THEN value - 60 END AS x_coord,
    CASE WHEN event_type NOT IN ('view', 'error') THEN value / 2 - 40 END AS y_coord
  FROM e
),
shifts AS (
  SELECT event_id AS shift_id, game_id, team AS team_id, 100 + user_id % 12 AS player_id,
    second AS start_abs_seconds, second + CAST(floor(value * 20) AS BIGINT) - 600 AS end_abs_seconds
  FROM e
)"""


def _event_base(view) -> DataFrame:
    return view("events").selectExpr(
        "*",
        "event_id div 40 AS game_id",
        "event_id % 40 * 120 + cast(floor(value) AS bigint) % 120 AS second",
        "cast(floor(value) AS bigint) AS whole",
        "user_id % 3 + 1 AS team",
    )


def plays(view) -> DataFrame:
    """Plays of ``events``; scores still as the feed sends them."""
    timed = _event_base(view).selectExpr(
        "event_id",
        "game_id",
        "cast(ts AS date) AS game_date",
        "2020 + game_id % 3 AS season",
        "second div 1200 + 1 AS period",
        """CASE WHEN event_type = 'view' AND value < 2 THEN NULL WHEN second < 3600 THEN 'REG'
           WHEN event_type = 'error' THEN 'SO' ELSE 'OT' END AS period_type""",
        """CASE WHEN NOT (event_type = 'error' AND value < 5)
           THEN concat(second % 1200 div 60, ':', lpad(second % 60, 2, '0')) END
           AS time_in_period""",
        """CASE event_type WHEN 'purchase' THEN 'GOAL' WHEN 'click' THEN 'SHOT'
           WHEN 'view' THEN 'FACEOFF' WHEN 'signup' THEN 'HIT' ELSE 'STOPPAGE' END AS event_type""",
        "CASE WHEN event_type <> 'view' THEN team END AS event_owner_team_id",
        "CASE WHEN event_type IN ('click', 'purchase') THEN 100 + user_id % 12 END AS shooter_id",
        "CASE WHEN event_type = 'purchase' THEN 100 + user_id % 12 END AS scorer_id",
        "1L AS home_team_id",
        "2L AS away_team_id",
        "CASE WHEN event_type = 'purchase' AND team <> 2 THEN whole % 6 END AS home_score",
        "CASE WHEN event_type = 'purchase' AND team <> 1 THEN whole % 5 END AS away_score",
        "CASE WHEN event_type <> 'view' THEN value - 60 END AS x_coord",
        "CASE WHEN event_type NOT IN ('view', 'error') THEN value / 2 - 40 END AS y_coord",
    )
    seconds = clock.clock_seconds(F.col("time_in_period"))
    return timed.withColumn("event_abs_seconds", clock.abs_seconds(F.col("period"), seconds))


def shifts(view) -> DataFrame:
    """A shift of every event; many are inverted or empty."""
    return _event_base(view).selectExpr(
        "event_id AS shift_id",
        "game_id",
        "team AS team_id",
        "100 + user_id % 12 AS player_id",
        "second AS start_abs_seconds",
        "second + cast(floor(value * 20) AS bigint) - 600 AS end_abs_seconds",
    )


# --- season results from lineitem ------------------------------------------------

RESULTS_SQL = """
results AS (
  SELECT l_orderkey AS game_id, 2020 + l_orderkey % 3 AS season,
    l_orderkey % 25 AS home_team_id,
    (l_orderkey % 25 + 1 + l_orderkey // 25 % 24) % 25 AS away_team_id,
    CAST(l_linenumber - 3 AS BIGINT) AS period,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'SHOOTOUT_COMPLETE'
         WHEN l_returnflag = 'A' THEN 'GOAL' ELSE 'SHOT' END AS event_type,
    CAST(floor(l_quantity) AS BIGINT) % 8 AS home_score_after,
    (CAST(floor(l_quantity) AS BIGINT) // 3 + l_linenumber) % 8 AS away_score_after,
    CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS scorer_id
  FROM lineitem
)"""


def results(view) -> DataFrame:
    """Plays of ``lineitem``: an order is a game of two of 25 teams."""
    return view("lineitem").selectExpr(
        "l_orderkey AS game_id",
        "2020 + l_orderkey % 3 AS season",
        "l_orderkey % 25 AS home_team_id",
        "(l_orderkey % 25 + 1 + l_orderkey div 25 % 24) % 25 AS away_team_id",
        "cast(l_linenumber - 3 AS bigint) AS period",
        """CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'SHOOTOUT_COMPLETE'
           WHEN l_returnflag = 'A' THEN 'GOAL' ELSE 'SHOT' END AS event_type""",
        "cast(floor(l_quantity) AS bigint) % 8 AS home_score_after",
        "(cast(floor(l_quantity) AS bigint) div 3 + l_linenumber) % 8 AS away_score_after",
        "CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS scorer_id",
    )


# --- games from orders -----------------------------------------------------------

GAMES_SQL = """
games AS (
  SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date,
    2020 + o_orderkey % 3 AS season, o_orderkey % 25 AS home_team_id,
    (o_orderkey % 25 + 1 + o_orderkey // 25 % 24) % 25 AS away_team_id,
    'T' || (o_orderkey % 25)::VARCHAR AS home_team_abbrev,
    'T' || ((o_orderkey % 25 + 1 + o_orderkey // 25 % 24) % 25)::VARCHAR AS away_team_abbrev,
    CASE o_orderstatus WHEN 'F' THEN 'FINAL' WHEN 'O' THEN 'OFF' ELSE 'LIVE' END AS game_state
  FROM orders
)"""


def games(view) -> DataFrame:
    return view("orders").selectExpr(
        "o_orderkey AS game_id",
        "cast(o_orderdate AS date) AS game_date",
        "2020 + o_orderkey % 3 AS season",
        "o_orderkey % 25 AS home_team_id",
        "(o_orderkey % 25 + 1 + o_orderkey div 25 % 24) % 25 AS away_team_id",
        "concat('T', o_orderkey % 25) AS home_team_abbrev",
        "concat('T', (o_orderkey % 25 + 1 + o_orderkey div 25 % 24) % 25) AS away_team_abbrev",
        "CASE o_orderstatus WHEN 'F' THEN 'FINAL' WHEN 'O' THEN 'OFF' ELSE 'LIVE' END AS game_state",
    )
