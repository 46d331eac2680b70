"""Documents as JSON text, read once and in any form of their numbers."""

import contextlib
import datetime
import io
import json

from pyspark.sql import functions as F

from rinkframe.bindings import documents
from rinkframe.operators import flatten
from rinkframe.sources import feeds


def _texts(spark, *payloads):
    return spark.createDataFrame(
        [(str(i), None, p) for i, p in enumerate(payloads)],
        "request_key string, feed_date date, payload string")


def _boxscore(number):
    skater = {"playerId": number(8), "goals": number(1), "faceoffWinningPctg": 0.5, "toi": "1:00"}
    return json.dumps({"id": number(5), "gameDate": "2024-10-08", "homeTeam": {"id": number(1)},
                       "awayTeam": {"id": number(2)},
                       "playerByGameStats": {"homeTeam": {"forwards": [skater, None]}}})


def test_documents_of_exact_and_loose_numbers_are_alike(spark):
    docs = feeds.parse_documents(
        _texts(spark, _boxscore(int), _boxscore(str), _boxscore(float), "nothing", " ", None, "{}"),
        "boxscore")
    got = docs.orderBy("request_key").collect()
    assert [r.is_broken for r in got] == [False, False, False, True, True, True, False]
    assert got[0].doc == got[1].doc == got[2].doc and got[0].doc.id == 5
    assert got[0].doc.playerByGameStats.homeTeam.forwards[0].goals == 1
    assert got[3].doc.id is None and got[5].doc.playerByGameStats is None
    rows = flatten.boxscore(docs).where("player_id IS NOT NULL").collect()
    assert [(r.game_id, r.player_id, r.goals, r.team_id) for r in rows] == [(5, 8, 1, 1)] * 3


def test_a_document_is_typed_once_however_often_it_is_read(spark):
    """Each of the sixteen reads of a boxscore's lists held a copy of the typed document."""
    rows = flatten.boxscore(feeds.parse_documents(_texts(spark, _boxscore(int)), "boxscore"))
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        rows.explain("extended")
    physical = plan.getvalue().split("== Physical Plan ==")[1]
    assert physical.count("from_json") == 2
    assert physical.count("transform(") <= 6


_ODD_BOXSCORES = [
    '{"id": 1, "gameDate": "d", "playerByGameStats": {"homeTeam": {"forwards": [%s]}}}' % player for player in (
        '{"playerId": 5, "goals": 2, "toi": "1:00"}', '{"playerId": "5", "goals": 2.0, "toi": {"a": 1}}',
        '{"playerId": 5, "goals": 2, "assists": "x", "saveShotsAgainst": [1]}', '{"playerId": {"a": 1}, "goals": "y"}',
        "7", "null", '{"goals": 1}, {"playerId": 5, "points": [1, 2], "goals": 3}', '{"playerId": 5, "goals": ')
] + ['{"playerByGameStats": 5}', '{"playerByGameStats": {"homeTeam": {"forwards": 5, "goalies": [{"goals": 4}]}}}',
     "[1]", "5", "no json", "", " ", "{}", '{"homeTeam": 5, "id": "x"}']


def test_few_fields_of_items_are_read_as_under_the_whole_type(spark):
    texts = spark.createDataFrame(
        [(str(k), None, t) for k, t in enumerate([*_ODD_BOXSCORES, None])],
        "request_key string, feed_date date, payload string")

    def seen(docs):
        players = flatten.boxscore_players(docs.withColumn("doc", F.col("doc").withField("id", F.col("request_key"))))
        return (sorted(tuple(r) for r in docs.select("request_key", "is_broken", "doc.id", "doc.gameDate").collect()),
                sorted(tuple(map(str, r)) for r in players.select(
                    "game_id", "category", "place", F.col("player").isNull(), "player.playerId", "player.goals").collect()))

    def by_key(found):
        return [sorted(map(repr, rows)) for rows in found]

    assert by_key(seen(feeds.parse_documents(texts, "boxscore", items=("playerId", "goals")))) == by_key(
        seen(feeds.parse_documents(texts, "boxscore")))


def test_the_check_of_a_game_reads_two_fields_of_its_players(spark):
    lines = spark.createDataFrame(
        [(1, 2, 3, 4, "A", datetime.date(2024, 1, 1))],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string, l_shipdate date")
    plan = documents.game_boxscore(lambda _name: lines)
    assert [tuple(r)[:3] for r in plan.collect()] == [("game_boxscore.goals", 1, 1)]
    whole = flatten.boxscore_players(feeds.parse_documents(_texts(spark, "{}"), "boxscore"))
    for frame, all_read in ((whole.select("player"), True), (plan, False)):
        with contextlib.redirect_stdout(io.StringIO()) as text:
            frame.explain("extended")
        read = text.getvalue().split("== Physical Plan ==")[1]
        assert "from_json" in read and ("faceoffWinningPctg" in read) == all_read
