"""Operators against plain Python on small and on random games."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rinkframe.operators import carry, checks, chunks, dedupe, discovery, onice, plays as play_ops, replace

EVENT = "event_id long, game_id long, event_abs_seconds long, home_team_id long, away_team_id long"
SHIFT = "game_id long, team_id long, player_id long, start_abs_seconds long, end_abs_seconds long"


def on_ice(spark, events, shifts, **options):
    df = onice.with_on_ice(
        spark.createDataFrame(events, EVENT), spark.createDataFrame(shifts, SHIFT), **options)
    return {r.event_id: (r.home_on_ice_ids, r.away_on_ice_ids, r.source_quality)
            for r in df.collect()}


def expected_on_ice(events, shifts):
    out = {}
    for event, game, t, home, away in events:
        mine = [s for s in shifts if s[0] == game]
        hit = [s for s in mine if t is not None and s[3] <= t < s[4]]
        out[event] = (
            sorted(s[2] for s in hit if s[1] == home),
            sorted(s[2] for s in hit if s[1] == away and away != home),
            "FULL" if mine else "NO_SHIFTS",
        )
    return out


def test_half_open_ends_teams_and_quality(spark):
    shifts = [(1, 1, 11, 0, 60), (1, 1, 11, 30, 90), (1, 2, 21, 60, 90), (1, 3, 31, 0, 90),
              (2, 1, 11, 50, 40)]
    events = [(1, 1, 30, 1, 2), (2, 1, 60, 1, 2), (3, 1, 90, 1, 2), (4, 1, None, 1, 2),
              (5, 2, 45, 1, 2), (6, 3, 10, 1, 2), (None, 1, 30, 1, 2)]
    got = on_ice(spark, events, shifts)
    assert got == expected_on_ice(events, shifts)
    assert got[1] == ([11, 11], [], "FULL") and got[2] == ([11], [21], "FULL")
    assert got[4] == ([], [], "FULL") and got[5] == ([], [], "FULL")
    assert got[6] == ([], [], "NO_SHIFTS")


numbers = st.integers(0, 400)
events_of = st.lists(
    st.tuples(st.integers(1, 3), st.one_of(st.none(), numbers), st.integers(1, 2)), max_size=25)
shifts_of = st.lists(
    st.tuples(st.integers(1, 2), st.integers(1, 3), st.integers(1, 5), numbers,
              st.one_of(numbers, st.just(10**6), st.just(10**9))), max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(events_of, shifts_of)
def test_on_ice_equals_nested_loops(spark, raw_events, shifts):
    events = [(i, g, t, home, 2) for i, (g, t, home) in enumerate(raw_events)]
    # One second wide buckets take short shifts to every level.
    assert on_ice(spark, events, shifts, bucket=1) == expected_on_ice(events, shifts)


def test_one_hot_game(spark):
    """A third of all rows in one game, many of them at one second."""
    pick = random.Random(7)
    events = [(i, 1 if i % 3 == 0 else i, 100 if i % 6 == 0 else pick.randrange(3600), 1, 2)
              for i in range(1500)]
    shifts = [(1 if i % 3 == 0 else pick.randrange(1500), pick.choice((1, 2)), i,
               s := pick.randrange(3600), s + pick.choice((40, 90, 4000))) for i in range(300)]
    assert on_ice(spark, events, shifts) == expected_on_ice(events, shifts)


def expected_carry(rows):
    """Walk every game in order, as a scorekeeper would."""
    last, out = {}, {}
    for game, pos, score in sorted(rows, key=lambda r: r[:2]):
        before = last.get(game, 0)
        after = before if score is None else score
        if after:
            last[game] = after
        out[(game, pos)] = (before, after)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 2), st.one_of(st.none(), st.integers(0, 3))), max_size=40),
       st.sampled_from([1, 3, 1 << 16]))
def test_carry_equals_a_walk(spark, raw, block):
    rows = [(game, i, score) for i, (game, score) in enumerate(raw)]
    df = spark.createDataFrame(rows, "game_id long, pos long, score long")
    got = carry.carry_scores(df, "pos", {"score": "score"}, block=block)
    assert {(r.game_id, r.pos): (r.score_before, r.score_after) for r in got.collect()} == (
        expected_carry(rows))


def test_keep_last_and_first(spark):
    df = spark.createDataFrame(
        [(1, 1, None), (1, 2, "b"), (2, 5, "c"), (2, 4, "d"), (None, 1, "e")],
        "k long, o long, v string")
    assert {tuple(r) for r in dedupe.keep_last(df, ["k"], ["o"]).collect()} == {
        (1, 2, "b"), (2, 5, "c"), (None, 1, "e")}
    assert {tuple(r) for r in dedupe.keep_first(df, ["k"], ["o"]).collect()} == {
        (1, 1, None), (2, 4, "d"), (None, 1, "e")}


@pytest.mark.parametrize(("kind", "start", "end", "want"), [
    ("month", "2024-10-01", "2024-12-15",
     [("2024-10-01", "2024-10-31"), ("2024-11-01", "2024-11-30"), ("2024-12-01", "2024-12-15")]),
    ("month", "2024-01-31", "2024-01-31", [("2024-01-31", "2024-01-31")]),
    ("year", "2023-06-02", "2024-02-29", [("2023-06-02", "2023-12-31"), ("2024-01-01", "2024-02-29")]),
    ("range", "2024-05-02", "2024-05-01", [("2024-05-02", "2024-05-01")]),
    ("month", "2024-05-02", "2024-05-01", []),
])
def test_chunk_plans(spark, kind, start, end, want):
    bounds = spark.createDataFrame([(start, end)], "start string, end string")
    got = chunks.plan_chunks(bounds, kind).orderBy("chunk_start").collect()
    assert [(str(a), str(b)) for a, b in got] == want


def test_unknown_chunk_kind(spark):
    with pytest.raises(ValueError, match="week"):
        chunks.plan_chunks(spark.range(1), "week")


def test_half_missing_coordinates_count_only_out_of_range(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0), (None, None), (50.0, None), (101.0, None), (None, -43.0), (100.0, 42.5)],
        "x_coord double, y_coord double")
    row = checks.play_checks(df, ("coords_in_bounds_or_null",)).first()
    assert (row.violations, row.total, row.passed) == (2, 6, False)


def test_checks_of_nothing_pass(spark):
    games = spark.createDataFrame([], "game_state string, game_date date")
    assert tuple(checks.future_games(games).first()) == ("no_future_games", 0, 0, True)
    empty = spark.createDataFrame([], "game_id long, event_id long")
    assert tuple(checks.duplicate_events(empty).first()) == ("no_duplicate_events", 0, 0, True)


def test_discovery_ignores_null_arrays(spark):
    df = spark.createDataFrame([(1, None, [3, 3]), (None, None, None)], "a long, b long, c array<long>")
    ids = discovery.player_ids(df, ("a", "b"), ("c",))
    assert sorted(r[0] for r in ids.collect()) == [1, 3]


def test_replace_window_keeps_null_dates_and_needs_rows(spark):
    schema = "id long, day date"
    read = lambda rows: spark.createDataFrame(rows, "id long, day string").select(
        "id", F.col("day").cast("date"))
    target = read([(1, None), (2, "2024-01-01"), (3, "2024-01-05"), (4, "2024-02-01")])
    new = read([(9, "2024-01-02"), (8, "2024-03-01")])
    got = replace.replace_window(target, new, "day", "2024-01-01", "2024-01-31")
    assert sorted(r.id for r in got.collect()) == [1, 4, 8, 9]
    none = spark.createDataFrame([], schema)
    got = replace.replace_window(target, none, "day", "2024-01-01", "2024-01-31")
    assert sorted(r.id for r in got.collect()) == [1, 2, 3, 4]


WIDE = (
    "game_id long, pos int, event_abs_seconds long, home_team_id long, away_team_id long, home_score long, "
    "away_score long, home_skaters_on_ice int, away_skaters_on_ice int, home_goalie_on_ice boolean, "
    "away_goalie_on_ice boolean, period_type string, event_type_desc string, time_in_period string"
)


def test_complete_plays_moves_wide_rows_once(spark):
    """Scores and players equal a walk along each game, and only one exchange has text in it."""
    rng = random.Random(12)
    plays = [
        (g, pos, rng.choice((None, rng.randrange(200))), 1, rng.choice((2, 2, 1)), rng.choice((None, 0, 0, pos)),
         rng.choice((None, 0, 1)), 5, 5, True, True, "REG", f"kind {pos}", "01:00")
        for g in (1, 2, 3) for pos in rng.sample(range(90), 40)
    ]
    shifts = [(rng.choice((1, 2)), rng.randint(1, 3), rng.randint(1, 6), a, a + rng.randint(-5, 90))
              for a in (rng.randrange(200) for _ in range(60))]
    limits = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.debug.maxToStringFields": "500"}
    before = {k: spark.conf.get(k) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    try:
        out = play_ops.complete_plays(spark.createDataFrame(plays, WIDE), spark.createDataFrame(shifts, SHIFT))
        text = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
        got = {(r.game_id, r.event_type_desc): r for r in out.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    moved = [b for b in text.split("\n\n") if re.match(r"\(\d+\) Exchange", b.strip()) and "event_type_desc" in b]
    assert len(moved) == 1
    assert len(got) == len(plays)
    events = [(p[12] + str(p[0]), p[0], *p[2:5]) for p in plays]
    iced = expected_on_ice(events, shifts)
    for g in (1, 2, 3):
        home = away = 0
        for p in sorted((p for p in plays if p[0] == g), key=lambda p: p[1]):
            r = got[g, p[12]]
            assert (r.home_score_before, r.away_score_before) == (home, away)
            assert r.home_score_after == (home if p[5] is None else p[5])
            assert r.away_score_after == (away if p[6] is None else p[6])
            home, away = p[5] or home, p[6] or away
            assert (r.home_on_ice_ids, r.away_on_ice_ids, r.source_quality) == iced[p[12] + str(g)]
