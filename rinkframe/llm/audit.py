"""Interaction of filters: what each removes, after every order of the others.

Every document is a cell: the set of filters it fails, as bits. The cells of one part
(a source) are counted in Spark; a walk over all sets of filters in Gray-code order
toggles one filter at a time, keeps for every cell how many active filters fail it, and
keeps the running survivors. With the survivors of all sets stored, what a step of any
order keeps and removes is the difference of two of them.

Defined cases: a null or empty text has no words, fails filter A alone (and E as a
repeat of an earlier empty text); rows without ``doc_id`` are compared with nothing by
E; repeated rows of one ``doc_id`` count each, and none is a repeat of the other; a
document is good or toxic if any of its label rows says so; an empty table gives no
rows. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkframe.llm.store import keep
from rinkframe.llm.words import utf8

FILTERS = "ABCDE"
LEAST_WORDS = 200
UPPER = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"

# What is counted of every set of documents.
COUNTS = ("docs", "good", "toxic")
AUDIT_TYPE = ("part string, filter_order string, step int, kept bigint, removed bigint, "
              "redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, "
              "shapley bigint")


def own_failures(text: bytes) -> int:
    """Bits of the filters A to D that one text fails by itself."""
    words = text.split()
    n = len(words)
    chars = len(text) if text.isascii() else len(text.decode())
    capitals = len(text) - len(text.translate(None, UPPER))
    return (
        (n < LEAST_WORDS)
        | (100 * len(set(words)) < 50 * n) << 1
        | (100 * capitals > 2 * chars) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def _facts(batches):
    for batch in batches:
        texts = list(utf8(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"),
             pa.array([own_failures(t) for t in texts], pa.int32()),
             pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
            ["doc_id", "part", "mask", "digest"])


def _counted(df: DataFrame) -> DataFrame:
    return df.groupBy("part", "mask").agg(
        F.count("*").alias("docs"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


def failure_cells(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """``part, mask, docs, good, toxic``: how many documents fail which filters.

    A repeat fails E. The earliest copy of each text is found by a minimum per digest,
    which is partly computed before the shuffle, and met again on digest and ``doc_id``
    together, so a text with a third of all rows is no hot key.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    facts = keep(source.mapInArrow(
        _facts, "doc_id bigint, part string, mask int, digest binary"), "audit-facts")
    said = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("bigint")).alias("good"),
        F.max((F.col("toxic") == 1).cast("bigint")).alias("toxic"))
    facts = facts.join(said, "doc_id", "left").fillna(0, ["good", "toxic"])
    earliest = (facts.filter("doc_id IS NOT NULL").groupBy("digest")
                .agg(F.min("doc_id").alias("doc_id")))
    passing = _counted(facts.join(earliest, ["digest", "doc_id"], "left_semi")
                       .unionByName(facts.filter("doc_id IS NULL")))
    repeat = F.lit(1 << FILTERS.index("E"))
    moved = passing.select("part", F.col("mask").bitwiseOR(repeat).alias("mask"),
                           *[(-F.col(c)).alias(c) for c in COUNTS])
    everyone = _counted(facts).withColumn("mask", F.col("mask").bitwiseOR(repeat))
    return (passing.unionByName(moved).unionByName(everyone).groupBy("part", "mask")
            .agg(*[F.sum(c).alias(c) for c in COUNTS]).filter("docs > 0"))


def survivors(masks: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """Row s: the counts of the cells that pass every filter of the set s.

    One walk over the 2^n sets in Gray-code order. ``failing`` holds for every cell how
    many active filters fail it; a cell leaves or comes back when that leaves or reaches
    zero.
    """
    states = np.zeros((1 << n, counts.shape[1]), np.int64)
    failing = np.zeros(len(masks), np.int64)
    alive = counts.sum(axis=0)
    states[0] = alive
    for k in range(1, 1 << n):
        bit = k & -k
        active = k ^ (k >> 1)
        hit = (masks & bit) != 0
        if active & bit:
            failing[hit] += 1
            alive = alive - counts[hit & (failing == 1)].sum(axis=0)
        else:
            failing[hit] -= 1
            alive = alive + counts[hit & (failing == 0)].sum(axis=0)
        states[active] = alive
    return states


def all_orders(masks: np.ndarray, counts: np.ndarray, names: str) -> dict[str, list]:
    """One row per order of the filters and step, from the stored states."""
    n = len(names)
    states = survivors(masks, counts, n)
    full = (1 << n) - 1
    total = states[0][0]
    fails = [int(total - states[1 << f][0]) for f in range(n)]
    alone = [int(states[full ^ (1 << f)][0] - states[full][0]) for f in range(n)]
    out: dict[str, list] = {c.split()[0]: [] for c in AUDIT_TYPE.split(", ")[1:-1]}
    shares, letters = [0] * n, []
    for order in permutations(range(n)):
        label, active = "".join(names[f] for f in order), 0
        for step, f in enumerate(order, 1):
            before, after = states[active], states[active | 1 << f]
            active |= 1 << f
            lost = (before - after).tolist()
            shares[f] += lost[0]
            letters.append(f)
            for column, value in zip(out, (label, step, int(after[0]), lost[0], fails[f] - lost[0],
                                           alone[f], lost[1], lost[2])):
                out[column].append(value)
    return out | {"shapley": [shares[f] for f in letters]}


def audit(cells: DataFrame, names: str = FILTERS) -> DataFrame:
    """All orders and steps of every part; bit f of ``mask`` is filter ``names[f]``.

    A part comes as at most 2^n counted cells, so its group is small whatever the number
    of its documents.
    """
    def walk(table: pa.Table) -> pa.Table:
        counts = np.column_stack([table.column(c).to_numpy() for c in COUNTS]).astype(np.int64)
        rows = all_orders(table.column("mask").to_numpy().astype(np.int64), counts, names)
        size = len(rows["step"])
        kinds = [pa.string(), pa.int32()] + [pa.int64()] * 7
        return pa.table(
            [pa.array([table.column("part")[0].as_py()] * size, pa.string())]
            + [pa.array(v, k) for v, k in zip(rows.values(), kinds)], ["part", *rows])

    return cells.groupBy("part").applyInArrow(walk, AUDIT_TYPE)
