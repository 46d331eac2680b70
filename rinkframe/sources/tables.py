"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def completed_chunks(runs: DataFrame) -> DataFrame:
    """Date pairs that one attempt finished, whatever came later."""
    done = F.col("status").isin("success", "empty")
    return runs.where(done).select("chunk_start", "chunk_end").distinct()
