"""Partitions swapped whole: killed at any step, nothing is half replaced."""

import pytest
from pyspark.sql import functions as F

from rinkframe.sinks import swap, tables as sink
from rinkframe.specs import OFFICIALS, PLAYERS
from tests.test_sinks import FIRST, SECOND, content, officials, players

WINDOW = ("2024-01-01", "2024-01-31")


class Killed(Exception):
    pass


def kill_at(monkeypatch, nth):
    """End the next run before its nth visible step; the names of the steps taken."""
    taken = []

    def step(name):
        if len(taken) == nth:
            raise Killed(name)
        taken.append(name)

    monkeypatch.setattr(swap, "_step", step)
    return taken


def by_day(rows):
    out = {}
    for row in rows:
        out.setdefault(row[1], set()).add(row)
    return out


@pytest.mark.parametrize("nth", range(8))
def test_killed_between_any_two_steps_a_day_is_old_or_new(spark, database, tmp_path, monkeypatch, nth):
    table = f"{database}.officials"
    sink.create_if_missing(spark, table, OFFICIALS)
    sink.replace_window(officials(spark, FIRST), table, OFFICIALS, "2024-01-01", "2024-12-31")
    old = by_day(FIRST)
    new = by_day([r for r in FIRST if r[1] is None or r[1] > WINDOW[1]] + SECOND)
    taken = kill_at(monkeypatch, nth)
    try:
        sink.replace_window(officials(spark, SECOND), table, OFFICIALS, *WINDOW)
        ended = True
    except Killed:
        ended = False
    got = by_day(content(spark, table))
    for day in old.keys() | new.keys():
        assert got.get(day, set()) in (old.get(day, set()), new.get(day, set())), (taken, day)
    assert ended == (nth >= 8) or nth == 7
    monkeypatch.setattr(swap, "_step", lambda name: None)
    swap.settle(spark, table)
    # Before the marker nothing happened, after it everything does, and just once.
    assert by_day(content(spark, table)) == (new if taken[:1] == ["marker"] else old)
    assert len(content(spark, table)) == sum(map(len, (new if taken else old).values()))
    sink.replace_window(officials(spark, FIRST[:2]), table, OFFICIALS, *WINDOW)
    assert by_day(content(spark, table))["2024-01-02"] == {FIRST[1]}


def test_a_run_without_a_marker_is_cleared_and_replaced_files_wait_for_the_next(spark, database):
    table = f"{database}.officials"
    sink.create_if_missing(spark, table, OFFICIALS)
    sink.replace_window(officials(spark, FIRST), table, OFFICIALS, *WINDOW)
    listed = spark.table(table).where("game_date <= '2024-01-31'").inputFiles()
    left = swap.stage(sink.conform(officials(spark, SECOND), OFFICIALS), table, "game_date")
    root = swap.location(spark, table)
    files = swap.Files(spark, root)
    assert files.exists(left.folder)
    sink.replace_window(officials(spark, SECOND), table, OFFICIALS, *WINDOW)
    assert not files.exists(left.folder)
    assert all(files.exists(f) for f in listed if "2024-01-02" in f)  # replaced, not dropped
    sink.replace_window(officials(spark, FIRST), table, OFFICIALS, *WINDOW)
    assert not any(files.exists(f) for f in listed)


def bucket_files(spark, table):
    rows = spark.table(table).select(sink.BUCKET, "player_id", F.col("_metadata.file_path").alias("f")).collect()
    return {r[0]: {x.f for x in rows if x[0] == r[0]} for r in rows}, {r.player_id: r[0] for r in rows}


def test_upsert_rewrites_touched_buckets_only_and_reads_its_source_once(spark, database):
    table = f"{database}.people"
    sink.create_if_missing(spark, table, PLAYERS)
    sink.upsert(players(spark, [(k, "a", None) for k in range(300)]), table, PLAYERS, ["player_id"])
    before, place = bucket_files(spark, table)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    source = players(spark, [(5, "new", None), (7, "new", None), (5000, "new", None)])
    assert sink.upsert(source.mapInArrow(counted, source.schema), table, PLAYERS, ["player_id"]) == 3
    assert read.value == 3
    after, place_after = bucket_files(spark, table)
    touched = {place_after[k] for k in (5, 7, 5000)}
    assert all(after[b] == before[b] for b in before if b not in touched)
    assert all(not (after[b] & before.get(b, set())) for b in touched)
    names = {r.player_id: r.full_name for r in spark.table(table).collect()}
    assert names == {k: "a" for k in range(300)} | dict.fromkeys((5, 7, 5000), "new")
    assert place.items() <= place_after.items()


def test_a_failed_upsert_leaves_the_old_rows(spark, database, monkeypatch):
    table = f"{database}.people"
    sink.create_if_missing(spark, table, PLAYERS)
    sink.upsert(players(spark, [(1, "a", None), (2, "a", None)]), table, PLAYERS, ["player_id"])
    change = players(spark, [(1, "b", None), (2, "b", None), (3, "b", None)])
    for nth, want in ((0, {1: "a", 2: "a"}), (1, dict.fromkeys((1, 2, 3), "b"))):
        kill_at(monkeypatch, nth)
        with pytest.raises(Killed):
            sink.upsert(change, table, PLAYERS, ["player_id"])
        monkeypatch.setattr(swap, "_step", lambda name: None)
        swap.settle(spark, table)
        assert {r.player_id: r.full_name for r in spark.table(table).collect()} == want
    spark.sql(f"CREATE TABLE {database}.plain (player_id BIGINT) USING parquet")
    with pytest.raises(ValueError, match="not dealt by a key"):
        sink.upsert(change, f"{database}.plain", PLAYERS, ["player_id"])
