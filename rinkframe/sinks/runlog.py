"""Log of chunk attempts, which makes a run resumable."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import SparkSession, types as T

from rinkframe.sinks import tables

ROW_COUNTS = ("plays", "games", "officials", "boxscore", "shifts", "standings")
SCHEMA = T.StructType([
    T.StructField("chunk_start", T.DateType(), False),
    T.StructField("chunk_end", T.DateType(), False),
    T.StructField("chunk_kind", T.StringType(), False),
    T.StructField("table_kind", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    *(T.StructField(f"rows_written_{name}", T.LongType()) for name in ROW_COUNTS),
    T.StructField("error", T.StringType()),
    T.StructField("run_at", T.TimestampType(), False),
])


def create_if_missing(spark: SparkSession, table: str) -> None:
    if not spark.catalog.tableExists(table):
        spark.createDataFrame([], SCHEMA).write.format("parquet").saveAsTable(table)


def record(
    spark: SparkSession,
    table: str,
    chunk: tuple[date, date],
    kind: str,
    status: str,
    rows: dict[str, int] | None = None,
    error: str | None = None,
) -> None:
    """Append one attempt with status success, empty or failed."""
    rows = rows or {}
    attempt = (
        *chunk, kind, "lockstep", status, *(rows.get(n) for n in ROW_COUNTS), error,
        datetime.now(UTC),
    )
    tables.append(spark.createDataFrame([attempt], SCHEMA), table)
