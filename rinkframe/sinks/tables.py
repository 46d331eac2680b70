"""Partitioned tables: create, replace a date window, append, upsert.

Tables are Parquet tables of the session catalog. They know no DELETE and no
MERGE, so whole partitions are replaced (``swap``): days of a window, or those
hash buckets of a key that an upsert touches.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.errors import PySparkValueError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from rinkframe.functions.coerce import conform
from rinkframe.operators import replace
from rinkframe.session import Stage
from rinkframe.sinks import swap
from rinkframe.specs import TableSpec

# Partition column of tables dealt by a key, and the table properties that say how.
BUCKET = "key_bucket"
_KEY, _BUCKETS = "rinkframe.key", "rinkframe.buckets"


@dataclass(frozen=True)
class Written:
    """Rows of one replacement, and those of them outside the window."""

    rows: int
    outside: int = 0


def create_if_missing(spark: SparkSession, table: str, spec: TableSpec) -> None:
    """Empty table with the schema, comments and partition column of its spec.

    A spec with a key makes a table dealt into hash buckets of that key.
    """
    if spark.catalog.tableExists(table):
        return
    if spec.key:
        create_keyed(spark, table, spec.struct_type(), list(spec.key), spec.buckets)
        return
    writer = spark.createDataFrame([], spec.struct_type()).write.format("parquet")
    if spec.partition_by:
        writer = writer.partitionBy(spec.partition_by)
    writer.saveAsTable(table)


def create_keyed(
    spark: SparkSession, table: str, schema: T.StructType, key: list[str], buckets: int
) -> None:
    """Empty table with one partition per hash bucket of a key, in ``key_bucket``.

    More buckets make an upsert rewrite less of a large table.
    """
    dealt = schema.add(T.StructField(BUCKET, T.IntegerType())) if BUCKET not in schema.names else schema
    spark.createDataFrame([], dealt).write.format("parquet").partitionBy(BUCKET).saveAsTable(table)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_KEY}'='{','.join(key)}', '{_BUCKETS}'='{buckets}')")


def _dealt_by(spark: SparkSession, table: str) -> tuple[list[str], int]:
    """Key and number of buckets of a table that ``create_keyed`` made."""
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if _KEY not in found:
        raise ValueError(f"{table} is not dealt by a key; create it with create_keyed")
    return found[_KEY].split(","), int(found[_BUCKETS])


def bucket_of(key: list[Column], buckets: int) -> Column:
    """Hash bucket of a key."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def layout(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of one day close together and sorted by the clustering columns.

    Rebalancing lets Spark split a day that is too large for one task and merge
    small days, from the sizes it sees at run time.
    """
    if not spec.partition_by:
        return df
    return df.hint("rebalance", spec.partition_by).sortWithinPartitions(
        spec.partition_by, *spec.cluster_by
    )


def _in_window_partitions(spark: SparkSession, table: str, field: str, start, end) -> set[str]:
    """Dates of the window that the table has a partition for, from the catalog."""
    names = spark.sql(f"SHOW PARTITIONS {table}")
    day = F.regexp_extract("partition", rf"(?:^|/){re.escape(field)}=([0-9-]+)", 1)
    inside = names.select(F.nullif(day, F.lit("")).alias("d")).where(
        replace.in_window("d", start, end))
    return {r.d for r in inside.collect()}


def replace_window(df: DataFrame, table: str, spec: TableSpec, start: str, end: str) -> Written:
    """Replace the rows of a closed date window by ``df``.

    * An empty frame changes nothing: rows written earlier stay.
    * Rows of ``df`` outside the window are appended; running again repeats them.
    * Rows with a NULL date are never removed.

    The frame is computed once, into a folder of its own. In-window dates are then
    pointed there, in-window dates without new rows dropped, and files of other dates
    moved. A reader sees the old or the new rows of a date, and a run that was ended
    halfway changes nothing or is finished by the next one (``swap``).
    """
    spark, field = df.sparkSession, spec.partition_by
    inside = replace.in_window(field, start, end)
    rows = layout(conform(df, spec), spec)
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    staged = swap.stage(
        rows.observe(seen, F.count("*").alias("rows"), F.count_if(~inside).alias("outside")), table, field)
    found = seen.get
    if found["rows"] == 0:
        staged.discard()
        return Written(0)
    new = staged.values
    window = [d for d in new if d is not None and str(start) <= d <= str(end)]
    before = _in_window_partitions(spark, table, field, start, end)
    staged.commit(window, drop=sorted(before.difference(window)), append=[d for d in new if d not in window])
    return Written(found["rows"], found["outside"])


def replace_games(df: DataFrame, table: str, spec: TableSpec, games: DataFrame, days: set[str]) -> int:
    """Replace the rows of some games, on the days given and those of the new rows.

    Only the partitions of these days are read and written. ``games`` has ``game_id``.
    Returns the number of new rows.
    """
    spark, field = df.sparkSession, spec.partition_by
    with Stage(spark) as stage:
        seen = Observation(f"rows-{uuid.uuid4().hex}")
        new = stage.keep(conform(df, spec).observe(seen, F.count("*").alias("rows")), "new")
        # One row per touched day.
        touched = days | {str(r[0]) for r in new.select(field).distinct().collect() if r[0] is not None}
        if not touched:
            return 0
        old = spark.table(table).where(F.col(field).isin([F.lit(d).cast("date") for d in sorted(touched)]))
        left = old.join(games.select("game_id").distinct(), "game_id", "left_anti")
        staged = swap.stage(layout(left.select(*spec.names).unionByName(new), spec), table, field)
        after = staged.values
        known = {p.split("=", 1)[1] for p in swap.partitions(spark, table)}
        staged.commit([d for d in after if d is not None], drop=sorted((touched & known).difference(after)),
                      append=[d for d in after if d is None])
        return seen.get["rows"]


def _insert(df: DataFrame, table: str, mode: str) -> None:
    """Insert by column position."""
    names = df.sparkSession.table(table).columns
    df.select(*names).write.mode(mode).insertInto(table)


def append(df: DataFrame, table: str) -> None:
    _insert(df, table, "append")


def _swap_buckets(new: DataFrame, table: str, kept) -> None:
    """Rewrite the buckets that ``new`` (with its bucket) has rows in, and no others.

    ``kept`` chooses the old rows of these buckets that stay.
    """
    spark = new.sparkSession
    # At most one row per bucket.
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())
    old = kept(spark.table(table).where(F.col(BUCKET).isin(touched)))
    names = spark.table(table).columns
    rows = old.select(*names).unionByName(new.select(*names))
    swap.stage(rows.hint("rebalance", BUCKET), table, BUCKET).commit([str(b) for b in touched])


def upsert(df: DataFrame, table: str, spec: TableSpec, keys: list[str]) -> int:
    """``upsert_rows`` of a frame brought into the form of a spec."""
    return upsert_rows(conform(df, spec), table, keys)


def upsert_rows(df: DataFrame, table: str, keys: list[str]) -> int:
    """Overwrite rows with the same key, add the others; returns the rows of ``df``.

    Every column is overwritten. Two source rows with one key are an error. The source is
    computed once. Only the buckets of its keys are read and written; files of the others
    stay as they are, and a failure before the swap leaves all old rows.
    """
    spark = df.sparkSession
    dealt, buckets = _dealt_by(spark, table)
    if list(keys) != dealt:
        raise ValueError(f"{table} is dealt by {dealt}, not {list(keys)}")
    swap.settle(spark, table)
    with Stage(spark) as stage:
        source = stage.keep(
            df.withColumn(BUCKET, bucket_of([F.col(k) for k in keys], buckets)), "source")
        groups = source.groupBy(*keys).count().agg(
            F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
            F.count_if(F.col("count") > 1).alias("repeated"),
        ).first()
        if groups["repeated"]:
            raise PySparkValueError(f"{groups['repeated']} keys occur more than once in the source")
        if groups["rows"]:
            _swap_buckets(source, table, lambda old: old.join(source.select(*keys), keys, "left_anti"))
        return groups["rows"]


def add_missing(df: DataFrame, table: str) -> int:
    """Add the distinct rows of ``df`` that a table dealt by a key lacks; returns how many.

    Only buckets that get a row are rewritten. Rows with a NULL are always added.
    """
    spark = df.sparkSession
    dealt, buckets = _dealt_by(spark, table)
    swap.settle(spark, table)
    with Stage(spark) as stage:
        source = stage.keep(df.distinct().withColumn(
            BUCKET, bucket_of([F.col(k) for k in dealt], buckets)), "source")
        # At most one row per bucket.
        touched = [r[0] for r in source.select(BUCKET).distinct().collect()]
        old = spark.table(table).where(F.col(BUCKET).isin(touched))
        seen = Observation(f"rows-{uuid.uuid4().hex}")
        new = stage.keep(source.join(old, source.columns, "left_anti")
                         .observe(seen, F.count("*").alias("rows")), "new")
        rows = seen.get["rows"]
        if rows:
            _swap_buckets(new, table, lambda old: old)
        return rows


def replace_by_key(df: DataFrame, table: str, key: dict[str, str]) -> int:
    """Replace the rows of one key by ``df``; returns its rows.

    Rows of ``df`` belong to that key. Only its bucket is read and written.
    """
    spark = df.sparkSession
    dealt, buckets = _dealt_by(spark, table)
    if set(key) != set(dealt):
        raise ValueError(f"{table} is dealt by {dealt}, not {list(key)}")
    swap.settle(spark, table)
    with Stage(spark) as stage:
        bucket = bucket_of([F.lit(key[k]) for k in dealt], buckets)
        seen = Observation(f"rows-{uuid.uuid4().hex}")
        new = stage.keep(df.withColumn(BUCKET, bucket).observe(seen, F.count("*").alias("rows")), "new")
        names = spark.table(table).columns
        at = spark.range(1).select(bucket).first()[0]
        old = spark.table(table).where(F.col(BUCKET) == at)
        staged = swap.stage(replace.replace_by_key(old.select(*names), new, key), table, BUCKET)
        known = f"{BUCKET}={at}" in swap.partitions(spark, table)
        staged.commit(staged.values, drop=[str(at)] if known and not staged.values else [])
        return seen.get["rows"]
