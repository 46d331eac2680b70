"""Documents that land in any order complete their games without a sync of the day."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from rinkframe.plans import sync
from rinkframe.plans.sync import SyncOptions
from rinkframe.specs import CHUNK_TABLES
from rinkframe.streaming import late
from tests.documents import Landing, game
from tests.test_sync import rows

DAY, NEXT = "2024-10-08", "2024-10-09"


def content(spark, options):
    out = {}
    for kind, spec in CHUNK_TABLES.items():
        frame = spark.table(options.table(kind)).drop("ingested_at")
        out[kind] = sorted(map(str, frame.select(*sorted(frame.columns)).collect()))
    return out


def whole_zone(root):
    zone = Landing(root)
    zone.put("score", DAY, {"games": [game(1), game(2), game(9, kind=1)]}, DAY)
    zone.put("standings", DAY, {"standings": [{"teamAbbrev": {"default": "T1"}, "wins": 1}]}, DAY)
    zone.put("score", NEXT, {"games": [game(3, NEXT)]}, NEXT)
    zone.put("standings", NEXT, {"standings": []}, NEXT)
    for n, day in ((1, DAY), (2, DAY), (3, NEXT)):
        zone.put_game(n, day)
    return sorted(p.relative_to(root) for p in root.rglob("*.json"))


@pytest.mark.parametrize("seed", [1])
def test_any_order_gives_the_tables_of_a_full_sync(spark, database, tmp_path, seed):
    source, zone = tmp_path / "all", tmp_path / "zone"
    names = whole_zone(source)
    random.Random(seed).shuffle(names)
    spark.sql(f"CREATE DATABASE {database}_full")
    full = SyncOptions(f"{database}_full", chunk_by="range")
    sync.sync(spark, str(source), DAY, NEXT, full)
    options = SyncOptions(database, chunk_by="range")
    # Folders of all feeds are there from the start, as a stream must be able to list them.
    for name in names:
        (zone / name).parent.mkdir(parents=True, exist_ok=True)
    cuts = [0, 6, 12, len(names)]
    for begin, end in zip(cuts, cuts[1:]):
        for name in names[begin:end]:
            (zone / name).write_text((source / name).read_text())
        late.follow(spark, str(zone), str(tmp_path / "state"), options)
    assert content(spark, options) == content(spark, full)
    assert late.open_games(spark, str(tmp_path / "state")).count() == 0


def test_a_late_document_completes_its_game_only(spark, database, tmp_path):
    zone, root, state = Landing(tmp_path / "zone"), str(tmp_path / "zone"), str(tmp_path / "state")
    options = SyncOptions(database, chunk_by="range")
    zone.put("score", DAY, {"games": [game(1), game(2)]}, DAY)
    zone.put("standings", DAY, {"standings": []}, DAY)
    zone.put_game(1)
    zone.put_game(2, landing=None)
    late.follow(spark, root, state, options, grace=timedelta(0))
    plays = options.table("plays")
    assert {r[0] for r in rows(spark, plays, "game_id")} == {1}
    assert [tuple(r) for r in late.open_games(spark, state).select(
        "game_id", F.col("feed_date").cast("string"), "missing").collect()] == [(2, DAY, "landing")]
    stamped = spark.table(plays).agg(F.max("ingested_at")).first()[0]
    # Grace is over, and another day's document makes the stream look.
    zone.put("score", NEXT, {"games": []}, NEXT)
    late.follow(spark, root, state, options, grace=timedelta(0))
    told = rows(spark, options.table("_ingest_late"), "game_id", "kind", "missing")
    assert told == [(2, "overdue", "landing")]
    zone.put("landing", 2, game(2, DAY, gameOutcome={"lastPeriodType": "OT"}), DAY)
    late.follow(spark, root, state, options, grace=timedelta(0))
    assert {r[0] for r in rows(spark, plays, "game_id")} == {1, 2}
    assert rows(spark, options.table("games"), "game_id", "final_period_type") == [(1, "REG"), (2, "OT")]
    # Game 1 was not built again, and no chunk ran: only the first sync of the day is logged.
    assert spark.table(plays).where("game_id = 1").agg(F.max("ingested_at")).first()[0] == stamped
    assert rows(spark, options.table("_ingest_runs"), "status") == [("success",)]
    assert rows(spark, options.table("_ingest_late"), "game_id", "kind") == [(2, "complete"), (2, "overdue")]


def test_what_is_missing():
    needed = late.bits(["score", "landing", "boxscore"])
    assert late.missing(late.bits(["score"]), needed) == "boxscore,landing"
    assert late.missing(needed, needed) == ""
