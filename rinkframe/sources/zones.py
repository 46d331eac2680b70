"""Where feed documents lie: a landing zone of files, or an archive of tables.

Plans ask either for the documents of some days, of named days and keys, or of the
keys in a frame. An ``Archive`` holds documents as JSON text in three catalog tables:

* ``<name>_days``: dated documents, one partition per ``feed_date``, sorted by feed and
  key, so that a feed is found by the minima and maxima in the files;
* ``<name>_players``: player documents, dealt into hash buckets of their key;
* ``<name>_keys``: the days a key was landed under, dealt the same way.

A look-up of some keys opens their buckets and days and nothing else, however many
documents there are. Spark's own file listing is spared too: the catalog knows the folders.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rinkframe.session import Stage
from rinkframe.sinks import swap, tables as sink
from rinkframe.sources import feeds

_DATED = "request_key string, feed string, payload string, feed_date date"
_PLAYER = "request_key string, payload string"
_KEYS = "request_key string, feed_date date"


@dataclass(frozen=True)
class Files:
    """Documents as files below a folder (see ``feeds``)."""

    spark: SparkSession
    root: str

    def days(self, feed: str, start: str | None = None, end: str | None = None) -> DataFrame:
        return feeds.read_feed(self.spark, self.root, feed, start, end)

    def named(self, feed: str, pairs: list[tuple[str, str]]) -> DataFrame:
        return feeds.read_feed(self.spark, self.root, feed, named=pairs)

    def of(self, feed: str, keys: DataFrame) -> DataFrame:
        """Files know no index: all documents of the feed are read."""
        return self.days(feed).join(keys.select("request_key"), "request_key", "left_semi")


@dataclass(frozen=True)
class Archive:
    """Documents as text in tables of a database.

    A document landed again under its feed, key and day replaces the earlier one. Keys of
    games and players are ids in plain decimal. A null or blank text is a broken document.
    """

    spark: SparkSession
    database: str = "default"
    name: str = "documents"
    buckets: int = 64

    def table(self, kind: str) -> str:
        """Full name of the table ``days``, ``players`` or ``keys``."""
        return f"{self.database}.{self.name}_{kind}"

    def create_if_missing(self) -> None:
        known = self.spark.catalog.tableExists
        if not known(self.table("days")):
            self.spark.createDataFrame([], _DATED).write.format("parquet").partitionBy(
                "feed_date").saveAsTable(self.table("days"))
        for kind, schema in (("players", _PLAYER), ("keys", _KEYS)):
            if not known(self.table(kind)):
                sink.create_keyed(
                    self.spark, self.table(kind), T.StructType.fromDDL(schema), ["request_key"], self.buckets)

    def land(self, texts: DataFrame) -> int:
        """Store documents (``feed, request_key, feed_date, payload``); returns how many.

        Only the days and buckets of the new documents are rewritten. The index of keys
        comes first: a run that ends between the tables leaves keys that find nothing yet,
        and landing again completes it. A feed nobody knows, a missing key, a missing day
        of a dated feed, or a document that comes twice is an error and nothing is stored.
        """
        self.create_if_missing()
        identity = ["feed", "request_key", "feed_date"]
        with Stage(self.spark) as stage:
            is_player = F.col("feed") == "player"
            new = stage.keep(texts.select(
                "feed", "request_key",
                F.when(~is_player, F.col("feed_date").cast("date")).alias("feed_date"), "payload"), "new")
            bad = ~F.coalesce(F.col("feed").isin(*feeds.FEEDS), F.lit(False)) | F.col("request_key").isNull() \
                | (~is_player & F.col("feed_date").isNull())
            found = new.groupBy(*identity).agg(F.count("*").alias("n"), F.bool_or(bad).alias("bad")).agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if("bad").alias("bad"),
                F.count_if(F.col("n") > 1).alias("repeated"),
                F.count_if(F.col("feed_date").isNotNull()).alias("dated")).first()
            if found["bad"] or found["repeated"]:
                raise ValueError(f"{found['bad']} documents lack a known feed, key or day, "
                                 f"{found['repeated']} come more than once")
            if found["dated"]:
                self._land_days(new.where(~is_player), identity)
            if found["rows"] > found["dated"]:
                sink.upsert_rows(new.where(is_player).select("request_key", "payload"),
                                 self.table("players"), ["request_key"])
            return found["rows"]

    def _land_days(self, new: DataFrame, identity: list[str]) -> None:
        sink.add_missing(new.select("request_key", "feed_date"), self.table("keys"))
        # One row per touched day.
        days = sorted(str(r[0]) for r in new.select("feed_date").distinct().collect())
        old = self._on_days(days).join(new.select(*identity), identity, "left_anti")
        rows = old.unionByName(new).hint("rebalance", "feed_date").sortWithinPartitions(
            "feed_date", "feed", "request_key")
        swap.stage(rows, self.table("days"), "feed_date").commit(days)

    def _on_days(self, days: list[str]) -> DataFrame:
        return self.spark.table(self.table("days")).where(
            F.col("feed_date").isin([F.lit(d).cast("date") for d in days]))

    def _dealt(self, kind: str, keys: DataFrame) -> DataFrame:
        """Rows of a dealt table for some keys; only their buckets are opened."""
        at = keys.select(sink.bucket_of([F.col("request_key")], self.buckets).alias("at")).distinct()
        # At most one row per bucket.
        touched = sorted(r["at"] for r in at.collect())
        rows = self.spark.table(self.table(kind)).where(F.col(sink.BUCKET).isin(touched))
        return rows.join(keys, "request_key", "left_semi")

    def days(self, feed: str, start: str | None = None, end: str | None = None) -> DataFrame:
        """Documents of one feed, dates inclusive; only partitions of the range are opened."""
        if feed == "player":
            texts = self.spark.table(self.table("players")).withColumn("feed_date", F.lit(None).cast("date"))
            return feeds.parse_documents(texts, feed)
        texts = self.spark.table(self.table("days")).where(F.col("feed") == feed)
        if start is not None:
            texts = texts.where(F.col("feed_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        return feeds.parse_documents(texts, feed)

    def named(self, feed: str, pairs: list[tuple[str, str]]) -> DataFrame:
        """Documents of the named days and keys."""
        asked = self.spark.createDataFrame(pairs, "feed_date string, request_key string").withColumn(
            "feed_date", F.col("feed_date").cast("date"))
        texts = self._on_days(sorted({day for day, _ in pairs})).where(F.col("feed") == feed)
        return feeds.parse_documents(texts.join(asked, ["feed_date", "request_key"], "left_semi"), feed)

    def of(self, feed: str, keys: DataFrame) -> DataFrame:
        """Documents of the keys in ``request_key``; buckets and days of others stay closed.

        The driver holds the numbers of the buckets and the days that the keys lie on.
        """
        keys = keys.select("request_key").where(F.col("request_key").isNotNull()).distinct()
        if feed == "player":
            texts = self._dealt("players", keys).withColumn("feed_date", F.lit(None).cast("date"))
            return feeds.parse_documents(texts, feed)
        found = self._dealt("keys", keys).select("request_key", "feed_date")
        days = sorted(str(r[0]) for r in found.select("feed_date").distinct().collect())
        texts = self._on_days(days).where(F.col("feed") == feed)
        return feeds.parse_documents(texts.join(keys, "request_key", "left_semi"), feed)


def zone_of(spark: SparkSession, landing: str | Archive) -> Files | Archive:
    """A folder's name, or an archive, as something plans read documents from."""
    return Files(spark, landing) if isinstance(landing, str) else landing


def one_key(spark: SparkSession, key: object) -> DataFrame:
    """A frame of keys with a single one."""
    return spark.range(1).select(F.lit(str(key)).alias("request_key"))
