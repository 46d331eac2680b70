"""Date chunks of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Chunk kinds and the calendar unit behind them.
KINDS = {"range": None, "year": "YEAR", "month": "MONTH"}


def plan_chunks(bounds: DataFrame, kind: str) -> DataFrame:
    """Chunks of each ``(start, end)`` row: calendar parts clipped to the bounds.

    ``range`` gives the bounds as they are, also reversed ones; the other kinds
    give nothing for reversed bounds.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown chunk kind: {kind!r}")
    start, end = F.col("start").cast("date"), F.col("end").cast("date")
    unit = KINDS[kind]
    if unit is None:
        return bounds.select(start.alias("chunk_start"), end.alias("chunk_end"))
    step = F.expr(f"INTERVAL 1 {unit}")
    first = F.explode(F.sequence(F.trunc(start, unit), F.trunc(end, unit), step))
    return (
        bounds.where(start <= end)
        .select(start.alias("s"), end.alias("e"), first.alias("first"))
        .select(
            F.greatest("s", "first").alias("chunk_start"),
            F.least("e", F.date_sub((F.col("first") + step).cast("date"), 1)).alias("chunk_end"),
        )
    )


def pending_chunks(chunks: DataFrame, completed: DataFrame) -> DataFrame:
    """Chunks that no attempt has finished, matched on their two dates."""
    return chunks.join(completed, ["chunk_start", "chunk_end"], "left_anti")
