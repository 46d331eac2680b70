"""Stored tables: windows, upserts, dictionary, comments."""

import pytest
from pyspark.errors import PySparkValueError
from pyspark.sql import functions as F

from rinkframe.operators import replace
from rinkframe.session import shared_folder
from rinkframe.sinks import dictionary, runlog, tables as sink
from rinkframe.specs import OFFICIALS, PLAYERS
from rinkframe.sources import tables as stored


def officials(spark, rows):
    return spark.createDataFrame(rows, "game_id long, game_date string, official_name string").select(
        "*", F.lit("REFEREE_1").alias("role"), F.current_timestamp().alias("ingested_at"))


def content(spark, table):
    got = spark.table(table).select("game_id", F.col("game_date").cast("string"), "official_name")
    return sorted((tuple(r) for r in got.collect()), key=str)


FIRST = [(1, "2024-01-01", "a"), (2, "2024-01-02", "a"), (3, "2024-01-03", "a"),
         (4, "2024-02-01", "a"), (5, None, "a")]
SECOND = [(6, "2024-01-02", "b"), (7, "2024-01-04", "b"), (8, "2024-02-01", "b"), (9, None, "b")]


def test_window_is_replaced(spark, database):
    table = f"{database}.officials"
    sink.create_if_missing(spark, table, OFFICIALS)
    sink.create_if_missing(spark, table, OFFICIALS)
    first, second = officials(spark, FIRST), officials(spark, SECOND)
    window = ("2024-01-01", "2024-01-31")
    assert sink.replace_window(first, table, OFFICIALS, "2024-01-01", "2024-12-31") == sink.Written(5, 1)
    assert content(spark, table) == sorted(FIRST, key=str)
    before = spark.createDataFrame(spark.table(table).collect(), spark.table(table).schema)
    assert sink.replace_window(second, table, OFFICIALS, *window) == sink.Written(4, 2)
    # The same as the rule on frames.
    want = replace.replace_window(
        before, sink.conform(second, OFFICIALS), "game_date", *window).select(
        "game_id", F.col("game_date").cast("string"), "official_name")
    assert content(spark, table) == sorted((tuple(r) for r in want.collect()), key=str)
    # Rows outside the window and without a date come again, the others do not.
    sink.replace_window(second, table, OFFICIALS, *window)
    assert len(content(spark, table)) == len(want.collect()) + 2
    # No rows, no change.
    kept = content(spark, table)
    assert sink.replace_window(officials(spark, []), table, OFFICIALS, *window) == sink.Written(0)
    assert content(spark, table) == kept


def players(spark, rows):
    return spark.createDataFrame(rows, "player_id long, full_name string, birth_date string")


def test_upsert(spark, database):
    table = f"{database}.people"
    sink.create_if_missing(spark, table, PLAYERS)
    assert sink.upsert(players(spark, [(1, "a", "2000-01-01"), (2, "b", "x")]), table, PLAYERS,
                       ["player_id"]) == 2
    change = players(spark, [(2, "c", None), (3, "d", None)])
    for _ in range(2):
        assert sink.upsert(change, table, PLAYERS, ["player_id"]) == 2
        got = spark.table(table).select("player_id", "full_name").collect()
        assert sorted(map(tuple, got)) == [(1, "a"), (2, "c"), (3, "d")]
    assert sink.upsert(players(spark, []), table, PLAYERS, ["player_id"]) == 0
    with pytest.raises(PySparkValueError):
        sink.upsert(players(spark, [(7, "a", None), (7, "b", None)]), table, PLAYERS, ["player_id"])
    assert spark.table(table).count() == 3


def test_dictionary_and_comments(spark, database):
    table = f"{database}.data_dictionary"
    for _ in range(2):
        assert dictionary.apply_dictionary(spark, table, OFFICIALS, "season") == 6
    assert dictionary.apply_dictionary(spark, table, PLAYERS, "season") == 14
    assert spark.table(table).count() == 20
    row = spark.table(table).where("`table` = 'dim_players' AND `column` = 'birth_date'").first()
    assert row.dtype == "DATE" and '"nhl_api_source_field":"birthDate"' in row.upstream_lineage_json
    people = f"{database}.people"
    sink.create_if_missing(spark, people, PLAYERS)
    dictionary.apply_comments(spark, people, PLAYERS)
    comment = spark.table(people).schema["shoots_catches"].metadata["comment"]
    assert "One of L, R." in comment and len(comment) <= 1024


def test_run_log(spark, database):
    from datetime import date

    table = f"{database}.runs"
    runlog.create_if_missing(spark, table)
    chunk, other = (date(2024, 1, 1), date(2024, 1, 31)), (date(2024, 2, 1), date(2024, 2, 29))
    runlog.record(spark, table, chunk, "month", "success", {"plays": 3, "games": 1})
    runlog.record(spark, table, chunk, "month", "failed", error="later attempt")
    runlog.record(spark, table, other, "month", "failed", error="no")
    got = stored.completed_chunks(spark.table(table)).collect()
    assert [tuple(r) for r in got] == [chunk]
    row = spark.table(table).where("status = 'success'").first()
    assert (row.rows_written_plays, row.rows_written_shifts, row.table_kind) == (3, None, "lockstep")


class _Session:
    """Only the settings that the choice of a shared folder looks at."""

    def __init__(self, master, **settings):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, *default: settings.get(key, *default))})()


def test_intermediate_data_needs_a_shared_folder():
    folder, warehouse = "spark.checkpoint.dir", "spark.sql.warehouse.dir"
    assert shared_folder(_Session("yarn", **{folder: "s3a://x/tmp"})) == "s3a://x/tmp"
    assert shared_folder(_Session("yarn", **{warehouse: "hdfs://n/warehouse"})) == "hdfs://n/warehouse"
    assert shared_folder(_Session("local[4]", **{warehouse: "file:/w"})) == "file:/w"
    for path in ("file:/w", "/w"):
        with pytest.raises(ValueError):
            shared_folder(_Session("yarn", **{warehouse: path}))
