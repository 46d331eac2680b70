"""Queries by name, each with its reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(view)`` under a name; ``view`` opens tables by name."""
    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))

        QUERIES[name] = Query(run, sql)
        return fn

    return add
