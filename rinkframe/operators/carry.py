"""Running values along a game."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BLOCK = 1 << 16


def carry_scores(
    df: DataFrame,
    position: str,
    scores: dict[str, str],
    keys: tuple[str, ...] = ("game_id",),
    block: int = BLOCK,
) -> DataFrame:
    """Add ``<name>_before`` and ``<name>_after`` for each ``name -> score column``.

    Going along ``position``, a whole number unique within the keys, the score
    before a row is the last one seen that was neither NULL nor 0, else 0; the
    score after it is the row's own, else the one before.

    Keys must not be NULL. A group is worked on in blocks of ``block`` positions, so that a group of any
    size spreads over many tasks: within a block by a window, across blocks by a
    window over one summary row per block.
    """
    number = F.floor(F.col(position) / block).cast("bigint")
    tagged = df.withColumn("_block", number)
    group = [*keys, "_block"]
    seen = {n: F.nullif(F.col(c), F.lit(0)) for n, c in scores.items()}

    # Last score of each block (combined before the shuffle), carried onwards.
    last = tagged.groupBy(*group).agg(*(
        F.max_by(F.col(c), F.when(seen[n].isNotNull(), F.col(position))).alias(f"_last_{n}")
        for n, c in scores.items()
    ))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    carried = last.select(*group, *(
        F.last(f"_last_{n}", ignorenulls=True).over(earlier).alias(f"_in_{n}") for n in scores
    ))

    within = Window.partitionBy(*group).orderBy(position).rowsBetween(
        Window.unboundedPreceding, -1)
    local = tagged.select("*", *(
        F.last(seen[n], ignorenulls=True).over(within).alias(f"_near_{n}") for n in scores
    ))
    # Same keys as the window: the rows are neither shuffled nor sorted again.
    joined = local.join(carried, group, "left")
    out = [F.col(c) for c in df.columns]
    for n, c in scores.items():
        before = F.coalesce(F.col(f"_near_{n}"), F.col(f"_in_{n}"), F.lit(0)).cast("bigint")
        out.append(before.alias(f"{n}_before"))
        out.append(F.coalesce(F.col(c).cast("bigint"), before).alias(f"{n}_after"))
    return joined.select(*out)
