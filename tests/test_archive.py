"""Documents as text in tables: the same plans, and only what is asked for is opened."""

import json

import pytest
from pyspark.sql import functions as F

from rinkframe.plans import players, sync, verify
from rinkframe.plans.sync import SyncOptions
from rinkframe.sinks import swap
from rinkframe.sources.zones import Archive, Files, one_key
from tests.documents import Landing, boxscore, game

TEXTS = "feed string, request_key string, feed_date string, payload string"


class Texts(Landing):
    """A landing zone whose documents are held as rows."""

    def __init__(self):
        self.rows = {}

    def put(self, feed, key, document, date=None):
        text = document if document is None or isinstance(document, str) else json.dumps(document)
        self.rows[feed, str(key), date] = text

    def frame(self, spark):
        return spark.createDataFrame([(*k, v) for k, v in self.rows.items()], TEXTS)


def zone(days=("2024-10-08",), first=0):
    out = Texts()
    for n, day in enumerate(days, first):
        out.put("score", day, {"games": [game(10 * n + k, day) for k in (1, 2)]}, day)
        out.put("standings", day, {"standings": [{"teamAbbrev": {"default": "T1"}, "wins": 1}]}, day)
        for k in (1, 2):
            out.put_game(10 * n + k, day)
    return out


def archive(spark, database, texts, **options):
    held = Archive(spark, database, **options)
    held.land(texts.frame(spark))
    return held


def keys(spark, *ids):
    return spark.createDataFrame([(str(i),) for i in ids], "request_key string")


def folders(df):
    """Partitions of the files that a frame opens."""
    return {f.split("/")[-2] for f in df.inputFiles()}


def test_a_sync_from_an_archive_equals_one_from_files(spark, database, tmp_path):
    texts = zone(("2024-10-08", "2024-10-09"))
    texts.put_game(12, "2024-10-09", shift_charts="{not json", landing=None)
    files = Landing(tmp_path)
    for (feed, key, day), text in texts.rows.items():
        files.put(feed, key, text, day)
    spark.sql(f"CREATE DATABASE {database}_files")
    held = archive(spark, database, texts)
    args = ("2024-10-08", "2024-10-09")
    got = sync.sync(spark, held, *args, SyncOptions(database))
    want = sync.sync(spark, str(tmp_path), *args, SyncOptions(f"{database}_files"))
    assert got == want and got[0]["plays"] == 9
    for table in ("nhl_plays", "games", "shifts", "boxscore_stats", "standings", "_ingest_skipped"):
        a, b = (spark.table(f"{d}.{table}").drop("ingested_at") for d in (database, f"{database}_files"))
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0, table
    with pytest.raises(ValueError, match="score 2024-10-10"):
        sync.sync(spark, held, "2024-10-10", "2024-10-10", SyncOptions(database))


def test_late_documents_complete_games_from_an_archive(spark, database):
    texts = zone()
    whole = texts.rows.pop(("landing", "2", "2024-10-08"))
    held = archive(spark, database, texts)
    sync.sync(spark, held, "2024-10-08", "2024-10-08", SyncOptions(database))
    assert {r.game_id for r in spark.table(f"{database}.nhl_plays").collect()} == {1}
    held.land(spark.createDataFrame([("landing", "2", "2024-10-08", whole)], TEXTS))
    late = spark.createDataFrame([(2, "2024-10-08")], "game_id bigint, feed_date string").withColumn(
        "feed_date", F.col("feed_date").cast("date"))
    assert sync.complete_games(spark, held, late, SyncOptions(database))["plays"] == 3
    assert {r.game_id for r in spark.table(f"{database}.nhl_plays").collect()} == {1, 2}


def test_a_look_up_opens_one_day_and_a_range_its_days(spark, database):
    days = [f"2024-10-{d:02d}" for d in range(1, 9)]
    held = archive(spark, database, zone(days), buckets=16)
    found = held.of("boxscore", one_key(spark, 32))
    assert [(r.request_key, str(r.feed_date), r.doc.id) for r in found.collect()] == [("32", "2024-10-04", 32)]
    # Files of the look-up: one day. The index is a bucket, read before.
    assert folders(found) == {"feed_date=2024-10-04"}
    assert len(folders(held._dealt("keys", one_key(spark, 32)))) == 1
    assert folders(held.days("score", "2024-10-02", "2024-10-03")) == {"feed_date=2024-10-02", "feed_date=2024-10-03"}
    assert held.days("score", "2024-10-02", "2024-10-03").count() == 2
    # As many files after twice the days were landed.
    held.land(zone([f"2024-11-{d:02d}" for d in range(1, 9)], 10).frame(spark))
    assert len(held.of("boxscore", one_key(spark, 32)).inputFiles()) == len(found.inputFiles()) == 1
    assert held.of("boxscore", one_key(spark, 99)).count() == 0
    # A game listed on two days has a document on each.
    held.land(spark.createDataFrame([("boxscore", "32", "2024-10-20", json.dumps(boxscore(32)))], TEXTS))
    assert sorted(str(r.feed_date) for r in held.of("boxscore", keys(spark, 32, 32, None)).collect()) == [
        "2024-10-04", "2024-10-20"]


def test_a_refresh_of_ten_ids_opens_ten_buckets_at_most(spark, database):
    texts = Texts()
    for n in range(400):
        texts.put("player", n, {"playerId": n, "firstName": {"default": f"P{n}"}})
    held = archive(spark, database, texts)
    some = held.of("player", keys(spark, *range(10)))
    assert {r.doc.playerId for r in some.collect()} == set(range(10))
    assert 1 < len(folders(some)) <= 10 and len(folders(held.days("player"))) == 64
    target = f"{database}.dim_players"
    assert players.refresh_players(spark, held, target, ids="3,5,4000") == 2
    before = set(spark.table(held.table("players")).inputFiles())
    held.land(spark.createDataFrame([("player", "3", None, '{"playerId": 3, "firstName": {"default": "New"}}')], TEXTS))
    assert len(before - set(spark.table(held.table("players")).inputFiles())) == 1
    assert players.refresh_players(spark, held, target, ids="3") == 1
    assert sorted((r.player_id, r.full_name) for r in spark.table(target).collect()) == [(3, "New"), (5, "P5")]


def test_verification_from_an_archive(spark, database):
    texts = zone()
    total = {"season": 20242025, "leagueAbbrev": "NHL", "gameTypeId": 2, "goals": 3}
    texts.put("player", 11, {"playerId": 11, "seasonTotals": [total]})
    held = archive(spark, database, texts)
    sync.sync(spark, held, "2024-10-08", "2024-10-08", SyncOptions(database))
    plays = f"{database}.nhl_plays"
    box = verify.verify_game_boxscore(spark, plays, held, 1)
    assert [tuple(r) for r in box.collect()] == [("game_boxscore.goals", 0, 1, True, 1)]
    people = {r["name"]: r["matched"] for r in verify.verify_player_season(spark, plays, held, 2024).collect()}
    assert people["player_season.goals"] == 1


def test_landing_again_replaces_and_odd_rows(spark, database):
    held = archive(spark, database, zone())
    again = [("score", "2024-10-08", "2024-10-08", '{"games": []}'), ("boxscore", "1", "2024-10-08", None),
             ("boxscore", "2", "2024-10-08", "  "), ("player", "7", "2024-10-08", "[1"), ("player", "8", None, "{}")]
    assert held.land(spark.createDataFrame(again, TEXTS)) == 5
    assert [r.doc.games for r in held.days("score").collect()] == [[]]
    assert [r.is_broken for r in held.days("boxscore").collect()] == [True, True]
    assert sorted((r.request_key, r.is_broken) for r in held.days("player").collect()) == [("7", True), ("8", False)]
    assert held.days("landing").count() == 2
    stored = spark.table(held.table("keys"))
    assert stored.count() == stored.distinct().count() == 3
    assert held.land(spark.createDataFrame([], TEXTS)) == 0
    for bad in ([("nothing", "1", "2024-10-08", "{}")], [("score", None, "2024-10-08", "{}")],
                [("score", "1", None, "{}")], [(None, "1", "2024-10-08", "{}")], [again[0]] * 2):
        with pytest.raises(ValueError):
            held.land(spark.createDataFrame(bad, TEXTS))
    assert held.days("score").count() == 1


@pytest.mark.parametrize("nth", range(6))
def test_killed_between_steps_landing_again_completes_it(spark, database, monkeypatch, nth):
    held = archive(spark, database, zone())
    old = {(r.feed, r.request_key): r.payload for r in spark.table(held.table("days")).collect()}
    texts = spark.createDataFrame([("boxscore", "1", "2024-10-08", "{}"), ("boxscore", "3", "2024-10-08", "{}"),
                                   ("player", "5", None, "{}")], TEXTS)
    taken = []

    def step(name):
        if len(taken) == nth:
            raise RuntimeError("killed")
        taken.append(name)

    monkeypatch.setattr(swap, "_step", step)
    with pytest.raises(RuntimeError):
        held.land(texts)
    got = {(r.feed, r.request_key): r.payload for r in spark.table(held.table("days")).collect()}
    assert got in (old, old | {("boxscore", "1"): "{}", ("boxscore", "3"): "{}"})
    monkeypatch.setattr(swap, "_step", lambda name: None)
    assert held.land(texts) == 3
    assert [r.is_broken for r in held.of("boxscore", keys(spark, 3)).collect()] == [False]
    assert held.of("player", keys(spark, 5)).count() == 1


def test_files_serve_the_same_questions(spark, tmp_path):
    files = Landing(tmp_path)
    files.put("player", 5, {"playerId": 5})
    files.put("player", 6, {"playerId": 6})
    zone = Files(spark, str(tmp_path))
    assert [r.request_key for r in zone.of("player", keys(spark, 6, 6)).collect()] == ["6"]
