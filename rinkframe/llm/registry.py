"""Queries of this package by name."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import rinkframe
from rinkframe.session import configure

# Texts reach Python in batches of this many rows.
BATCH_ROWS = 1000


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this library to the executors' Python workers, once per application."""
    context = spark.sparkContext
    if getattr(context, "_rinkframe_shipped", False):
        return
    source = Path(rinkframe.__file__).parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='rinkframe-')}/rinkframe", "zip", source.parent, source.name)
    context.addPyFile(archive)
    context._rinkframe_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, table)``; ``table(name)`` opens a table of the folder."""
    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return fn(spark, lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))

        QUERIES[name] = Query(run, sql)
        return fn

    return add
