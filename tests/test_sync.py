"""Documents on disk to stored tables, and back through verification."""

import pytest
from pyspark.sql import functions as F

from rinkframe.plans import players, sync, verify
from rinkframe.plans.sync import SyncOptions
from rinkframe.streaming import incremental
from tests.documents import Landing, boxscore, game, play, play_by_play, shift


def rows(spark, table, *columns):
    return sorted(tuple(r) for r in spark.table(table).select(*columns).collect())


def two_games(tmp_path, **second):
    zone = Landing(tmp_path)
    zone.put("score", "2024-10-08", {"games": [game(1), game(2), game(9, kind=1)]}, "2024-10-08")
    zone.put("standings", "2024-10-08",
             {"standings": [{"teamAbbrev": {"default": "T1"}, "wins": 1}]}, "2024-10-08")
    zone.put_game(1)
    zone.put_game(2, **second)
    return zone


def test_all_tables_of_a_chunk(spark, database, tmp_path):
    two_games(tmp_path).fill("2024-10-01", "2024-10-31")
    options = SyncOptions(database)
    assert sync.sync(spark, str(tmp_path), "2024-10-01", "2024-10-31", options) == [
        {"games": 3, "officials": 6, "boxscore": 4, "shifts": 4, "plays": 6, "standings": 1}]
    got = rows(spark, f"{database}.nhl_plays", "game_id", "event_id", "home_on_ice_ids",
               "away_on_ice_ids", "home_score_before", "home_score_after", "strength_state")
    assert got[:3] == [
        (1, 1, [11], [21], 0, 0, "EV"), (1, 2, [11], [21], 0, 1, "EV"), (1, 3, [], [21], 1, 1, "EV")]
    assert rows(spark, f"{database}.game_officials", "role", "official_name")[:2] == [
        ("LINESMAN_1", "C"), ("LINESMAN_1", "C")]
    assert rows(spark, f"{database}.games", "game_id", "game_type", "final_period_type") == [
        (1, "R", "REG"), (2, "R", "REG"), (9, "PR", None)]
    assert rows(spark, f"{database}._ingest_runs", "status", "rows_written_plays") == [("success", 6)]
    # A second run replaces what it finds.
    sync.sync(spark, str(tmp_path), "2024-10-01", "2024-10-31", options)
    assert spark.table(f"{database}.nhl_plays").count() == 6
    assert spark.table(f"{database}.games").count() == 3


def test_resume_skips_finished_chunks(spark, database, tmp_path):
    zone = two_games(tmp_path)
    zone.fill("2024-10-01", "2024-11-15")
    options = SyncOptions(database, resume=True)
    assert len(sync.sync(spark, str(tmp_path), "2024-10-01", "2024-11-15", options)) == 2
    assert sync.sync(spark, str(tmp_path), "2024-10-01", "2024-11-15", options) == []
    assert [r[0] for r in rows(spark, f"{database}._ingest_runs", "status")] == ["empty", "success"]


def test_a_day_that_did_not_land_fails_its_chunk_until_it_does(spark, database, tmp_path):
    zone = two_games(tmp_path)
    zone.fill("2024-10-07", "2024-10-09")
    options = SyncOptions(database, resume=True, chunk_by="range")
    with pytest.raises(ValueError, match="score 2024-10-10, standings 2024-10-10"):
        sync.sync(spark, str(tmp_path), "2024-10-07", "2024-10-10", options)
    assert rows(spark, f"{database}._ingest_runs", "status") == [("failed",)]
    zone.fill("2024-10-10", "2024-10-10")
    assert len(sync.sync(spark, str(tmp_path), "2024-10-07", "2024-10-10", options)) == 1
    assert sync.sync(spark, str(tmp_path), "2024-10-07", "2024-10-10", options) == []


def test_payload_id_unlike_the_requested_one(spark, database, tmp_path):
    odd = play_by_play(777, [play(1, time="0:30", hittingPlayerId=11), play(2, time="0:40")])
    zone = two_games(tmp_path, play_by_play=odd)
    sync.sync(spark, str(tmp_path), "2024-10-08", "2024-10-08", SyncOptions(database))
    got = rows(spark, f"{database}.nhl_plays", "game_id", "event_id", "home_on_ice_ids", "source_quality")
    assert [r for r in got if r[0] == 777] == [(777, 1, [11], "FULL"), (777, 2, [11], "FULL")]
    assert zone


def test_numbers_in_any_form(spark, database, tmp_path):
    odd = play_by_play(2, [play(1, "penalty", time="0:30", duration=2.0, xCoord="12", playerId="11")])
    charts = {"data": [shift(2, 11.0, "1", "0:00", "1:00"), shift(2, 12, 1, "0:00", "1:00", number=None),
                       shift("2", "21", 2.0, "0:00", "1:30", number="3")]}
    box = boxscore(2, [{"playerId": 11, "goals": "3", "pim": 2.0}])
    two_games(tmp_path, play_by_play=odd, shift_charts=charts, boxscore=box)
    sync.sync(spark, str(tmp_path), "2024-10-08", "2024-10-08", SyncOptions(database))
    plays = spark.table(f"{database}.nhl_plays").where("game_id = 2").collect()
    assert [(p.penalty_minutes, p.x_coord, p.home_on_ice_ids, p.away_on_ice_ids) for p in plays] == [(2, 12.0, [11], [21])]
    stored = rows(spark, f"{database}.shifts", "game_id", "player_id", "shift_number")
    assert [r for r in stored if r[0] == 2] == [(2, 11, 1), (2, 12, 0), (2, 21, 3)]
    stats = spark.table(f"{database}.boxscore_stats").where("game_id = 2").select("goals", "pim").collect()
    assert [tuple(s) for s in stats] == [(3, 2)]


# Game id, documents that differ from a sound game, failing stage, tables kept.
BROKEN = [
    (2, {"landing": None}, "fetch", ()),
    (3, {"shift_charts": "{not json"}, "fetch", ()),
    (4, {"play_by_play": play_by_play(4, [play(1, time="5:60")])}, "plays", ()),
    (5, {"landing": {"id": 5, "homeTeam": {"id": 1}}}, "games", ("plays",)),
    (6, {"boxscore": boxscore(6, [{"goals": 1}])}, "boxscore", ("plays", "officials")),
    (7, {"shift_charts": {"data": [shift(7, 11, None, "0:00", "1:00"),
                                   shift(7, 21, 2, "0:00", "1:00")]}},
     "shifts", ("plays", "officials", "boxscore")),
]


def test_a_bad_game_is_skipped_from_its_failing_stage_on(spark, database, tmp_path):
    zone = Landing(tmp_path)
    zone.put("score", "2024-10-08", {"games": [game(n) for n in range(1, 8)]}, "2024-10-08")
    zone.put("standings", "2024-10-08", {}, "2024-10-08")
    zone.put_game(1)
    for game_id, replaced, _, _ in BROKEN:
        zone.put_game(game_id, **replaced)
    sync.sync(spark, str(tmp_path), "2024-10-08", "2024-10-08", SyncOptions(database))
    assert rows(spark, f"{database}._ingest_skipped", "game_id", "stage") == [
        (n, stage) for n, _, stage, _ in BROKEN]
    names = {"plays": "nhl_plays", "officials": "game_officials", "boxscore": "boxscore_stats",
             "shifts": "shifts"}
    for kind, table in names.items():
        games = {r[0] for r in rows(spark, f"{database}.{table}", "game_id")}
        assert games == {1} | {n for n, _, _, kept in BROKEN if kind in kept}, kind
    # The score row of a skipped game stays; its landing row is used only if reached.
    final = rows(spark, f"{database}.games", "game_id", "final_period_type")
    assert final == [(1, "REG"), (2, None), (3, None), (4, None), (5, None), (6, "REG"), (7, "REG")]


def test_bad_score_fails_the_chunk(spark, database, tmp_path):
    zone = two_games(tmp_path)
    zone.put("score", "2024-10-09", {"games": [{"gameType": 2}]}, "2024-10-09")
    with pytest.raises(ValueError, match="score document 2024-10-09"):
        sync.sync(spark, str(tmp_path), "2024-10-01", "2024-10-31", SyncOptions(database))
    assert rows(spark, f"{database}._ingest_runs", "status") == [("failed",)]


def test_table_subset_and_preseason(spark, database, tmp_path):
    zone = two_games(tmp_path)
    zone.put_game(9)
    options = SyncOptions(database, tables=("games",), include_preseason=True)
    got = sync.sync(spark, str(tmp_path), "2024-10-08", "2024-10-08", options)
    assert got == [{"games": 3, "officials": 0, "boxscore": 0, "shifts": 0, "plays": 9,
                    "standings": 0}]
    assert not spark.catalog.tableExists(f"{database}.shifts")


def test_players_from_plays_and_by_id(spark, database, tmp_path):
    zone = two_games(tmp_path)
    zone.put("player", 11, {"playerId": 11, "firstName": {"default": "Foo"},
                            "lastName": {"default": "Bar"}, "birthDate": "1999-02-03"})
    zone.put("player", 21, {"playerId": 21, "firstName": {"default": "Solo"}})
    zone.put("player", 33, "{broken")
    sync.sync(spark, str(tmp_path), "2024-10-08", "2024-10-08", SyncOptions(database))
    target, plays = f"{database}.dim_players", f"{database}.nhl_plays"
    assert players.refresh_players(spark, str(tmp_path), target, plays_table=plays) == 2
    assert players.refresh_players(spark, str(tmp_path), target, plays_table=plays) == 0
    assert rows(spark, target, "player_id", "full_name") == [(11, "Foo Bar"), (21, "Solo")]
    zone.put("player", 11, {"playerId": 11, "firstName": {"default": "New"}})
    assert players.refresh_players(spark, str(tmp_path), target, ids="11, ,33") == 1
    assert rows(spark, target, "player_id", "full_name") == [(11, "New"), (21, "Solo")]
    with pytest.raises(ValueError):
        players.refresh_players(spark, str(tmp_path), target)


def test_verification_of_stored_tables(spark, database, tmp_path):
    zone = two_games(tmp_path)
    zone.put("score", "2025-04-30", {"games": []}, "2025-04-30")
    zone.put("standings", "2025-04-30", {"standings": [
        {"teamAbbrev": {"default": "T1"}, "wins": 2, "losses": 0, "otLosses": 0, "points": 4,
         "goalFor": 2, "goalAgainst": 0},
        {"teamAbbrev": {"default": "T2"}, "wins": 2, "losses": 0, "otLosses": 0, "points": 4,
         "goalFor": 9, "goalAgainst": 2},
    ]}, "2025-04-30")
    total = {"season": 20242025, "leagueAbbrev": "NHL", "gameTypeId": 2, "goals": 3}
    zone.put("player", 11, {"playerId": 11, "seasonTotals": [total | {"gameTypeId": 3}, total]})
    options = SyncOptions(database, chunk_by="range")
    for day in ("2024-10-08", "2025-04-30"):
        sync.sync(spark, str(tmp_path), day, day, options)
    t = {k: options.table(k) for k in ("plays", "games", "shifts", "standings")}

    internal = verify.verify_internal(
        spark, t["plays"], t["shifts"], t["games"], F.lit("2024-10-07").cast("date"))
    got = {r["name"]: (r["violations"], r["total"], r["passed"]) for r in internal.collect()}
    assert got["on_ice_skater_count_valid"] == (6, 6, False)
    assert got["no_orphan_event_player"] == (0, 4, True)
    assert got["no_future_games"] == (3, 3, False)
    assert got["shifts_valid_intervals"] == (0, 4, True)
    assert len(got) == 8

    teams = verify.verify_team_season(spark, t["plays"], t["games"], t["standings"], 2024)
    got = {r["name"]: (r["violations"], r["matched"]) for r in teams.collect()}
    assert got["team_season.wins"] == (1, 2)
    assert got["team_season.goal_for"] == (1, 2)
    assert got["team_season.losses"] == (1, 2)

    people = verify.verify_player_season(spark, t["plays"], str(tmp_path), 2024)
    got = {r["name"]: (r["violations"], r["matched"]) for r in people.collect()}
    assert got["player_season.goals"] == (1, 1) and got["player_season.hits"] == (0, 1)

    box = verify.verify_game_boxscore(spark, t["plays"], str(tmp_path), 1)
    assert [tuple(r) for r in box.collect()] == [("game_boxscore.goals", 0, 1, True, 1)]


def test_new_score_files_drive_a_sync(spark, database, tmp_path):
    zone = two_games(tmp_path / "zone")
    options = SyncOptions(database, chunk_by="range")
    args = (spark, str(tmp_path / "zone"), str(tmp_path / "state"), options)
    incremental.sync_new(*args)
    assert spark.table(f"{database}.nhl_plays").count() == 6
    zone.put("score", "2024-10-09", {"games": [game(3, "2024-10-09")]}, "2024-10-09")
    zone.put("standings", "2024-10-09", {"standings": []}, "2024-10-09")
    zone.put_game(3, "2024-10-09")
    incremental.sync_new(*args)
    assert spark.table(f"{database}.nhl_plays").count() == 9
    assert spark.table(f"{database}._ingest_runs").count() == 2
