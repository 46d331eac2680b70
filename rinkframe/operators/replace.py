"""Replacing parts of a table, as frames; the sinks apply the same rules to files."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F


def in_window(field: str, start, end) -> Column:
    """Inside the closed date window; never true for NULL."""
    inside = F.col(field).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return F.coalesce(inside, F.lit(False))


def replace_window(target: DataFrame, new: DataFrame, field: str, start, end) -> DataFrame:
    """Rows outside the window, and all new rows, also those outside it.

    Without new rows nothing is deleted.
    """
    kept = target.where(~in_window(field, start, end) | ~new.exists())
    return kept.unionByName(new.select(*target.columns))


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows, and target rows with a key that the source does not have."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def replace_by_key(target: DataFrame, new: DataFrame, key: dict[str, str]) -> DataFrame:
    """Rows of other keys, and all new rows."""
    same = reduce(and_, (F.col(k) == v for k, v in key.items()))
    return target.where(~F.coalesce(same, F.lit(False))).unionByName(new.select(*target.columns))
