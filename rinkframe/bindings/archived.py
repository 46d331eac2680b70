"""Documents stored as text in catalog tables and found again by key."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from rinkframe import session
from rinkframe.bindings.documents import LANDING_SQL, PLAYERS_SQL, _plain, landing_texts, player_texts
from rinkframe.bindings.registry import query
from rinkframe.operators import flatten
from rinkframe.sources.zones import Archive


def through_archive(feed: str, texts: DataFrame, find: Callable[[Archive], DataFrame]) -> DataFrame:
    """What ``find`` reads from an archive of the texts; its tables go when it has read."""
    spark, database = texts.sparkSession, f"rinkframe_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    try:
        archive = Archive(spark, database)
        archive.land(texts.withColumn("feed", F.lit(feed)))
        return session.cut_lineage(find(archive))
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


@query("src8_players_by_id", f"""SELECT * FROM ({PLAYERS_SQL})
WHERE player_id IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def players_by_id(view):
    """Documents of all customers are stored; those of customers with a finished order are asked for."""
    ids = view("orders").where("o_orderstatus = 'F'").selectExpr("cast(o_custkey AS string) AS request_key")
    return through_archive(
        "player", player_texts(view), lambda archive: _plain(flatten.players(archive.of("player", ids))))


@query("src7_games_by_key", f"""WITH {LANDING_SQL}
SELECT * EXCLUDE (feed_date, pos) FROM landing_rows
WHERE game_id IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50)""")
def games_by_key(view):
    """Landing documents of all orders, stored under the first of their month; those of
    orders with a line of 50 pieces are asked for, without a word of their days."""
    keys = view("lineitem").where("l_quantity = 50").selectExpr("cast(l_orderkey AS string) AS request_key")
    stored = landing_texts(view("orders"), "trunc(cast(o_orderdate AS date), 'month')")
    return through_archive(
        "landing", stored, lambda archive: _plain(flatten.games_from_landing(archive.of("landing", keys))))
