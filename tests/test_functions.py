"""Truth tables of the column expressions."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from rinkframe.functions import clock, codes, coerce
from rinkframe.specs import BOXSCORE, GAMES, PLAYS, TABLES, ColumnSpec


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_clock_text(spark):
    good = {"0:00": 0, "1:30": 90, "19:59": 1199, "20:00": 1200, "  5:00  ": 300, "+1:05": 65}
    bad = ["5", "", "  ", "5:60", "-1:00", "1:-5", "1:2:3", "1::2", "a:10", ":10", "5:"]
    texts = [*good, *bad, None]
    assert column(spark, texts, clock.clock_seconds) == [*good.values(), *[None] * len(bad), None]
    assert column(spark, texts, clock.clock_is_bad) == (
        [False] * len(good) + [True] * len(bad) + [False])


def test_absolute_seconds(spark):
    cases = [(1, "5:00", 300), (3, "20:00", 3600), (4, "3:45", 3825), (5, None, None),
             (None, "5:00", None)]
    df = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(cases)], "i int, p int, t string")
    got = df.orderBy("i").select(clock.abs_seconds(F.col("p"), clock.clock_seconds(F.col("t"))))
    assert [r[0] for r in got.collect()] == [c[2] for c in cases]


def test_strength_labels(spark):
    cases = [
        (5, 5, True, True, "EV"), (5, 4, True, True, "PP_H"), (4, 5, True, True, "PP_A"),
        (3, 3, True, True, "3v3"), (4, 4, True, True, "4v4"), (6, 6, True, True, "6v6"),
        (6, 5, False, True, "EN_H"), (5, 6, True, False, "EN_A"), (6, 5, False, False, "PP_H"),
        (0, 5, True, True, None), (None, 5, True, True, None), (5, 5, None, True, None),
    ]
    df = spark.createDataFrame(
        [(i, *c[:4]) for i, c in enumerate(cases)], "i int, h int, a int, hg boolean, ag boolean")
    label = codes.strength_state(*(F.col(c) for c in ("h", "a", "hg", "ag")))
    assert [r[0] for r in df.orderBy("i").select(label).collect()] == [c[4] for c in cases]


def test_names_and_codes(spark):
    df = spark.createDataFrame(
        [(0, "Foo", "Bar"), (1, None, "Bar"), (2, "Foo", ""), (3, "", None)],
        "i int, a string, b string")
    got = df.orderBy("i").select(codes.full_name(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == ["Foo Bar", "Bar", "Foo", None]
    assert codes.snake_case("evenStrengthShotsAgainst") == "even_strength_shots_against"
    assert column(spark, ["1551", "155", "15x1", None], lambda c: codes.situation(c)["home_skaters"]) == [
        5, None, None, None]
    assert column(spark, [20242025, None], clock.season_start, "long") == [2024, None]
    assert column(spark, [2024], clock.season_code, "long") == [20242025]


def test_clock_forms_of_casts(spark):
    good = {"\t1 : +07\x7f": 67, "-0:-00": 0, "2:0059": 179, "153722867280912930:07": 2**63 - 1}
    bad = ["1:60", "1:0060", "-1:00", "1:+", "1.0:00", "1:00\u2028", "9" * 20 + ":00", "1:1e1"]
    assert column(spark, [*good, *bad], clock.clock_seconds) == [*good.values(), *[None] * len(bad)]
    assert column(spark, [*good, *bad], clock.clock_is_bad) == [False] * len(good) + [True] * len(bad)


def test_whole_numbers_of_text_and_numbers(spark):
    cases = {"12": 12, " +12\t": 12, "12.0": 12, "1.2e1": 12, ".0": 0, "\u0661": 1, "12.5": None,
             "25/26": None, "nobody": None, "": None, "1e30": None, "9" * 20: None, "+": None}
    assert column(spark, [*cases, None], coerce.whole_number) == [*cases.values(), None]
    assert column(spark, ["7", "3000000000", "7.0"], lambda c: coerce.whole_number(c, "int")) == [7, None, 7]
    assert column(spark, [2.5, 3.0, float("nan")], coerce.whole_number, "double") == [2, 3, None]


def test_text_that_is_no_number_raises_nothing(spark):
    """A failing cast costs a stack trace for each value, so it must not be reached."""
    texts = spark.createDataFrame([("25/26",)], "x string")
    for value in (coerce.whole_number(F.col("x")), F.expr(coerce.to_type(
            "x", texts.schema["x"].dataType, BOXSCORE.columns[0].spark_type.__class__()))):
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            texts.select(value).explain()
        assert "RLIKE" in plan.getvalue().upper()


def test_saves_and_shots(spark):
    cases = [  # raw, saves, shots -> saves, shots
        ('"19/22"', None, None, 19, 22), ("22", None, None, None, 22), ("22.9", None, None, None, 22),
        ('"22"', None, None, None, None), ('"x/22"', None, None, None, None),
        ('"19/x"', None, None, 19, None), ('"x/22"', 7, None, 7, 22), ('"19/22"', 7, 8, 7, 8),
        ("null", 1, None, 1, None), (None, None, 4, None, 4),
    ]
    df = spark.createDataFrame(
        [(i, *c[:3]) for i, c in enumerate(cases)], "i int, raw string, s long, n long")
    parts = coerce.save_counts(F.parse_json("raw"), F.col("s"), F.col("n"))
    got = df.orderBy("i").select(*(p.alias(n) for p, n in zip(parts, "ab"))).collect()
    assert [tuple(r) for r in got] == [c[3:] for c in cases]


def test_coercion_to_a_table(spark):
    df = spark.createDataFrame(
        [(1, "2024-10-08", "25/26", "2024-10-08T23:00:00Z", "yes", [1, None])],
        "game_id int, game_date string, home_score_final string, start_time_utc string, "
        "is_shootout_decided string, home_on_ice_ids array<long>")
    row = coerce.conform(df, GAMES).first()
    assert str(row.game_date) == "2024-10-08" and row.home_score_final is None
    assert row.is_shootout_decided is True and row.venue_default_name is None
    assert row.start_time_utc.hour == 23
    plays = coerce.conform(df, PLAYS)
    assert plays.columns == PLAYS.names
    row = plays.first()
    assert row.home_on_ice_ids == [1] and row.away_on_ice_ids == []


def test_specs_are_sound():
    assert {t: len(s.columns) for t, s in TABLES.items()} == {
        "games": 18, "game_officials": 6, "boxscore_stats": 35, "shifts": 13, "nhl_plays": 55,
        "standings": 17, "dim_players": 14}
    for spec in TABLES.values():
        assert len(set(spec.names)) == len(spec.names)
        assert set(spec.cluster_by) <= set(spec.names)
        assert spec.partition_by in (None, *spec.names)
    for broken in ({"type": "TEXT"}, {"mode": "ANY"}, {"summary": " "}):
        with pytest.raises(ValueError):
            ColumnSpec(**({"name": "c", "type": "INT64", "mode": "NULLABLE", "summary": "s"} | broken))
