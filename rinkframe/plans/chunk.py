"""The tables of one date chunk, as a plan over document frames.

A game that cannot be unpacked is skipped without failing its chunk, but not as
a whole: its tables come in the order plays, games, officials, boxscore, shifts,
and those before the first failing one are kept. Whether a document can be
unpacked is told from the document alone, one row per game, so no rows have to
be grouped by game to find out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rinkframe.operators import dedupe, flatten, plays as play_ops
from rinkframe.sources import feeds
from rinkframe.specs import CHUNK_TABLES

ALL_TABLES = tuple(CHUNK_TABLES)
# Order in which one game's tables are built; a failure stops the later ones.
STAGES = ("fetch", "plays", "games", "officials", "boxscore", "shifts")
_FEED_OF = {
    "plays": "play_by_play", "games": "landing", "officials": "right_rail",
    "boxscore": "boxscore", "shifts": "shift_charts",
}
_SIMPLE = {
    "officials": flatten.officials, "boxscore": flatten.boxscore, "shifts": flatten.shifts,
}
_REASONS = {
    "fetch": "a document is missing or is no JSON",
    "plays": "a play has no readable clock, or the game lacks id, season, type or teams",
    "games": "the landing document lacks id or teams",
    "officials": "",
    "boxscore": "the boxscore lacks id, teams or a player id",
    "shifts": "a timed shift lacks game, player or team",
}


class ChunkPlan:
    """Tables of one chunk, each planned when it is asked for."""

    def __init__(self, docs, tables, work_list, status, keep):
        self.docs, self.work_list, self.status = docs, work_list, status
        self.names = tuple(t for t in CHUNK_TABLES if t in tables or t == "plays")
        self._keep = keep

    def _documents(self, table: str, feed: str | None = None) -> DataFrame:
        return kept_documents(self.docs[feed or _FEED_OF[table]], self.status, table)

    def table(self, name: str) -> DataFrame:
        if name == "standings":
            return flatten.standings(self.docs["standings"])
        if name == "games":
            return dedupe.latest_games(
                flatten.games_from_score(self.docs["score"], keep=("feed_date", "pos")),
                flatten.games_from_landing(self._documents("games"), keep=("feed_date",)),
            )
        if name == "plays":
            asked = self._documents("plays").withColumnRenamed("game_id", "asked_id")
            rows = self._keep(play_ops.play_rows(asked, keep=("asked_id",)), "play_rows")
            charts = self._documents("plays", "shift_charts")
            merged = self._keep(flatten.merge_shifts(charts), "merge_shifts")
            return play_ops.complete_plays(rows, merged, key="asked_id")
        return _SIMPLE[name](self._documents(name))

    @property
    def skipped(self) -> DataFrame:
        """Games that failed: ``game_id, game_date, stage, reason``."""
        failed = self.status.where(F.col("failed_at").isNotNull())
        reason = F.element_at(
            F.create_map(*(F.lit(x) for kv in _REASONS.items() for x in kv)), F.col("stage"))
        stage = F.element_at(F.array(*(F.lit(s) for s in STAGES)), F.col("failed_at") + 1)
        return failed.withColumn("stage", stage).select(
            "game_id", "game_date", "stage", reason.alias("reason"))

    def row_counts(self) -> DataFrame:
        """Rows per table, a table without rows included.

        Nothing is joined to count plays: who was on the ice adds no row.
        """
        def rows(name: str) -> DataFrame:
            return play_ops.play_rows(self._documents(name)) if name == "plays" else self.table(name)

        return reduce(DataFrame.unionByName, (
            rows(n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows")
            for n in self.names
        ))


def needed_feeds(tables) -> tuple[str, ...]:
    """Feeds to read for a set of tables; plays are always built."""
    wanted = ["score", "play_by_play", "shift_charts", "landing"]
    wanted += [f for t, f in (("boxscore", "boxscore"), ("officials", "right_rail"),
                              ("standings", "standings")) if t in tables]
    return tuple(wanted)


def fatal_documents(docs: dict[str, DataFrame], tables=ALL_TABLES) -> DataFrame:
    """Score and standings documents that make the whole chunk fail."""
    g = F.col("game")
    bad = g["id"].isNull()
    if "games" in tables:
        bad = bad | g["homeTeam"]["id"].isNull() | g["awayTeam"]["id"].isNull()
    rows = flatten.score_games(docs["score"]).where(bad).select(
        F.lit("score").alias("feed"), F.col("feed_date").cast("string").alias("request_key"),
        F.lit("a game lacks id or teams").alias("reason"),
    )
    for feed in feeds.DATE_FEEDS:
        if feed in docs:
            broken = docs[feed].where("is_broken").select(
                F.lit(feed).alias("feed"), "request_key", F.lit("no JSON").alias("reason"))
            rows = rows.unionByName(broken)
    return rows


def missing_days(docs: dict[str, DataFrame], start: str, end: str) -> DataFrame:
    """Days of a chunk whose score or standings document did not land: ``feed, day``."""
    spark = docs["score"].sparkSession
    days = spark.range(1).select(
        feeds.dates_between(F.lit(start).cast("date"), F.lit(end).cast("date")).alias("feed_date"))
    return reduce(DataFrame.unionByName, (
        days.join(docs[feed].select("feed_date"), "feed_date", "left_anti")
        .select(F.lit(feed).alias("feed"), F.col("feed_date").cast("string").alias("day"))
        for feed in feeds.DATE_FEEDS if feed in docs
    ))


def _exists(items: Column, test) -> Column:
    return F.coalesce(F.exists(items, test), F.lit(False))


def _boxscore_is_bad() -> Column:
    d = F.col("doc")
    bad = d["id"].isNull() | d["homeTeam"]["id"].isNull() | d["awayTeam"]["id"].isNull()
    for side in ("homeTeam", "awayTeam"):
        for group in ("forwards", "defense", "goalies"):
            players = d["playerByGameStats"][side][group]
            bad = bad | _exists(players, lambda p: p["playerId"].isNull())
    return bad


def _usable(docs: DataFrame, *columns: Column) -> DataFrame:
    """Narrow per-game facts of the readable documents of one feed."""
    return docs.where(~F.col("is_broken")).select(
        F.col("request_key").try_cast("bigint").alias("game_id"), "feed_date", *columns)


def game_status(docs: dict[str, DataFrame], work_list: DataFrame, tables=ALL_TABLES) -> DataFrame:
    """One row per listed game: header facts and the first stage that fails.

    ``failed_at`` is the index in ``STAGES``, NULL if the game is fine. All joins
    are on game and day and carry a few columns per game.
    """
    key = ["game_id", "feed_date"]
    d = F.col("doc")
    landing_bad = d["id"].isNull() | d["homeTeam"]["id"].isNull() | d["awayTeam"]["id"].isNull()
    facts = {
        "landing": _usable(
            docs["landing"],
            F.struct("doc.id", "doc.gameDate", "doc.season", "doc.gameType", "doc.homeTeam",
                     "doc.awayTeam").alias("landing"),
            landing_bad.alias("games_bad"),
            F.lit(True).alias("has_landing"),
        ),
        "play_by_play": _usable(
            docs["play_by_play"],
            F.struct("doc.id", "doc.gameDate", "doc.season", "doc.gameType", "doc.homeTeam",
                     "doc.awayTeam").alias("own"),
            play_ops.clock_is_bad(d["plays"]).alias("clock_bad"),
            F.lit(True).alias("has_play_by_play"),
        ),
        "shift_charts": _usable(
            docs["shift_charts"],
            _exists(d["data"], flatten.shift_row_is_bad).alias("shifts_bad"),
            F.lit(True).alias("has_shift_charts"),
        ),
    }
    if "boxscore" in tables:
        facts["boxscore"] = _usable(
            docs["boxscore"], _boxscore_is_bad().alias("boxscore_bad"),
            F.lit(True).alias("has_boxscore"))
    if "officials" in tables:
        facts["right_rail"] = _usable(docs["right_rail"], F.lit(True).alias("has_right_rail"))

    joined = work_list.select("game_id", "game_date", "feed_date")
    for frame in facts.values():
        joined = joined.join(frame, key, "left")
    present = F.lit(True)
    for feed in facts:
        present = present & F.col(f"has_{feed}").isNotNull()
    failing = F.when(~present, STAGES.index("fetch"))
    failing = failing.when(
        F.col("clock_bad") | play_ops.header_is_bad("own", "landing"), STAGES.index("plays"))
    for table in ("games", "boxscore", "shifts"):
        if table in tables:
            failing = failing.when(F.col(f"{table}_bad"), STAGES.index(table))
    return joined.withColumn("failed_at", failing.cast("int")).select(
        "game_id", "game_date", "feed_date", "landing", "failed_at")


def kept_documents(docs: DataFrame, status: DataFrame, table: str) -> DataFrame:
    """Documents of the games whose stage for a table is reached and sound."""
    sound = status.where(
        F.col("failed_at").isNull() | (F.col("failed_at") > STAGES.index(table)))
    keyed = docs.withColumn("game_id", F.col("request_key").try_cast("bigint"))
    return keyed.join(sound.select("game_id", "feed_date", "game_date", "landing"),
                      ["game_id", "feed_date"])


def plan_chunk(
    docs: dict[str, DataFrame],
    tables: tuple[str, ...] = ALL_TABLES,
    include_preseason: bool = False,
    keep=lambda df, name: df,
    only: DataFrame | None = None,
) -> ChunkPlan:
    """Plan of all tables of one chunk from its document frames.

    ``keep`` is called on frames that several tables read; a sync stores them.
    The score feed lists all games in ``games``, preseason ones too; only the
    list of games to unpack leaves them out. ``only`` (``game_id, feed_date``) narrows
    that list to some games.
    """
    work_list = dedupe.work_list(flatten.score_games(docs["score"]), include_preseason)
    if only is not None:
        work_list = work_list.join(only, ["game_id", "feed_date"], "left_semi")
    status = keep(game_status(docs, work_list, tables), "status")
    return ChunkPlan(docs, tables, work_list, status, keep)
