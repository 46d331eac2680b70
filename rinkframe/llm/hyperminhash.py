"""Near-duplicates by HyperMinHash.

Every text's set of word shingles is reduced to registers: for each of several
independent hashes, the leading zeros of the smallest value and the bits behind
them. Four registers form a band; texts that share a band are candidates. A
collision-corrected estimate of the Jaccard similarity from all registers drops
most of them, and the rest are confirmed on their full sets.

Texts with equal sets form a class, which takes part once. Links between classes
are found in two rounds, and no bucket is ever expanded into all its pairs:

1. every class against one member of each of its buckets: of each class the best
   estimates are verified and components formed, then the best between components;
2. every component against the classes that share a bucket with a hub of it, and
   those among themselves, in blocks of bounded size: registers first, then sets.

All pairs of classes that share a band are thus either in one component after the
first round or tested in the second.

Defined cases: a null text, or one without words, has no shingles and is linked
with nothing; a text with fewer words than a shingle has its whole word sequence as
its only one; repeated rows are copies of each other; rows that share a doc_id with
different texts are judged each by its text; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkframe.llm.graph import components
from rinkframe.llm.store import keep
from rinkframe.llm.words import (
    hashed, lean, mix, odd_numbers, pack5, unpack5, utf8, window_hashes, word_hashes,
)

SHINGLE = 5
# Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
# 32 bands of 4 registers miss a pair at similarity 0.75 once in 190,000 times.
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
MANTISSA = 10
# Pairs estimated below this are dropped: five standard deviations under 0.75.
LEAST_ESTIMATE = 0.55
# Members of each side that one block holds, and rows that one task's group holds.
BLOCK = 512
GROUP_ROWS = 4_000
# Ids up to this number (8 MB) are broadcast; more are joined by shuffle.
MAX_BROADCAST = 1_000_000

_FACTORS = odd_numbers(REGISTERS, 10)
_OFFSETS = odd_numbers(REGISTERS, 11)
_SALTS = odd_numbers(BANDS, 12)
SIGNATURE = "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint, registers binary"


def shingles(text: bytes, table, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    values = hashed(words, table)
    if len(words) < size:
        return window_hashes(values, len(words), 100 + len(words))
    return np.unique(window_hashes(values, size))


def registers(values: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of the smallest value under each hash."""
    least = np.empty(REGISTERS, np.uint64)
    for k in range(0, REGISTERS, 16):
        least[k:k + 16] = (values * _FACTORS[k:k + 16, None] + _OFFSETS[k:k + 16, None]).min(axis=1)
    part, exponent = np.frexp(least.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 63).astype(np.uint16)
    bits = np.clip((2 * part - 1) * (1 << MANTISSA), 0, (1 << MANTISSA) - 1).astype(np.uint16)
    return (zeros << np.uint16(MANTISSA)) | bits


def band_keys(signature: bytes) -> np.ndarray:
    return mix(np.frombuffer(signature, np.uint64) ^ _SALTS).view(np.int64)


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers of sets of ``n`` and ``m``.

    Registers of unrelated sets agree when both minima fall into one cell. A cell at x
    is about 0.7213 x / 2**MANTISSA wide, which integrates to the chance below.
    """
    n, m = np.maximum(n, 1).astype(float), np.maximum(m, 1).astype(float)
    chance = 0.7213 / (1 << MANTISSA) * n * m / (n + m) ** 2
    return np.clip((equal / REGISTERS - chance) / (1 - chance), 0, 1)


def signatures(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: size and fingerprint of its set, and its registers."""
    def make(batches):
        table = word_hashes()
        for batch in batches:
            n, one, two, made = [], [], [], []
            for b in utf8(batch.column(1)):
                s = shingles(b, table)
                n.append(len(s))
                print_ = xxhash.xxh3_128_intdigest(s.tobytes())
                one.append(((print_ >> 64) ^ (1 << 63)) - (1 << 63))
                two.append(((print_ & (2**64 - 1)) ^ (1 << 63)) - (1 << 63))
                made.append(registers(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()),
                 pa.array(two, pa.int64()), pa.array(made, pa.binary())],
                ["doc_id", "n_shingles", "h1", "h2", "registers"])

    source = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(lean(make), SIGNATURE)


def _bands(classes: DataFrame) -> DataFrame:
    """``key, id, n`` for every band of every class."""
    def make(batches):
        for batch in batches:
            keys = [band_keys(b) for b in batch.column(2).to_pylist()]
            repeat = lambda k: np.repeat(batch.column(k).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)),
                 pa.array(repeat(0)), pa.array(repeat(1))], ["key", "id", "n"])

    return classes.select("id", "n", "registers").mapInArrow(lean(make), "key bigint, id bigint, n bigint")


def _fits(n, m):
    """Sets of these sizes can reach the similarity."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Add ``chance``, the estimated similarity, to pairs ``a, b`` and drop low ones."""
    def similar(a: pa.Array, b: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
        def matrix(x):
            return np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(-1, REGISTERS)
        equal = (matrix(a) == matrix(b)).sum(axis=1)
        return pa.array(estimate(equal, n.to_numpy(), m.to_numpy()), pa.float64())

    def side(k):
        return classes.select(F.col("id").alias(k), F.col("n").alias(f"n_{k}"), F.col("registers").alias(f"r_{k}"))
    udf = F.arrow_udf(similar, "double")
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .select("a", "b", udf("r_a", "r_b", "n_a", "n_b").alias("chance"))
            .filter(F.col("chance") >= LEAST_ESTIMATE))


def _upper(values: np.ndarray) -> np.ndarray:
    """The upper 40 bits of each hash: two sets of 20,000 get one false match in 2,700."""
    return values >> np.uint64(24)


def _full_sets(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id, set`` for the wanted ids: the full sets, sorted, five bytes a shingle."""
    small = wanted.count() <= MAX_BROADCAST

    def full(batches):
        table = word_hashes()
        for batch in batches:
            sets = [pack5(_upper(shingles(b, table))) for b in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "set"])

    texts = (source.withColumnRenamed("doc_id", "id")
             .join(F.broadcast(wanted) if small else wanted, "id", "left_semi"))
    return texts.select("id", "text").mapInArrow(lean(full), "id bigint, set binary")


def _verified(pairs: DataFrame, source: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets reach the similarity."""
    pairs = keep(pairs.select("a", "b"), "pairs")
    wanted = keep(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "wanted")

    def enough(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist()):
            p, q = unpack5(x), unpack5(y)
            common = len(np.intersect1d(p, q, assume_unique=True))
            out.append(100 * common >= PERCENT * (len(p) + len(q) - common))
        return pa.array(out, pa.bool_())

    sets, udf = _full_sets(source, wanted), F.arrow_udf(enough, "boolean")
    return keep(pairs.join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
                .join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
                .filter(udf("set_a", "set_b")).select("a", "b").distinct(), "links")


PAIR = "a bigint, b bigint"
LIVE = "family bigint, x bigint, y bigint, id bigint"


def _blocks(table: pa.Table, columns: list[str]):
    """Sorted columns of a group, its row order, and (first, split, end) of each block.

    Members before ``split`` meet those behind it; a block of one side has none behind
    and its members meet each other.
    """
    values = {c: table.column(c).to_numpy() for c in ("family", "x", "y", "id", "left", *columns)}
    order = np.lexsort((values["id"], values["left"], values["y"], values["x"], values["family"]))
    values = {c: v[order] for c, v in values.items()}
    change = np.any([values[c][1:] != values[c][:-1] for c in ("family", "x", "y")], axis=0)
    cuts = np.concatenate(([0], np.flatnonzero(change) + 1, [len(order)])).tolist()
    blocks = []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        split = hi - int(values["left"][lo:hi].sum())
        blocks.append((lo, hi if split == lo else split, hi))
    return values, order, blocks


def _others(values: dict, i: int, split: int, hi: int) -> np.ndarray:
    """Places that member ``i`` is compared with: other components, sizes that fit."""
    lo = i + 1 if split == hi else split
    n, m = values["n"][i], values["n"][lo:hi]
    fits = (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)) & (values["label"][i] != values["label"][lo:hi])
    return lo + np.flatnonzero(fits)


def _live_members(table: pa.Table) -> pa.Table:
    """Members of blocks that some other member's registers come near."""
    values, order, blocks = _blocks(table, ["n", "label"])
    regs = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16)
    regs = regs.reshape(-1, REGISTERS)[order]
    live = np.zeros(len(order), bool)
    for lo, split, hi in blocks:
        for i in range(lo, split):
            j = _others(values, i, split, hi)
            if len(j):
                equal = (regs[j] == regs[i]).sum(axis=1)
                j = j[estimate(equal, np.full(len(j), values["n"][i]), values["n"][j]) >= LEAST_ESTIMATE]
                live[j] = True
                live[i] |= len(j) > 0
    return pa.table({c: pa.array(values[c][live], pa.int64()) for c in ("family", "x", "y", "id")})


def _block_links(table: pa.Table) -> pa.Table:
    """Links of a block on full sets: enough of them to join all that are linked."""
    values, order, blocks = _blocks(table, ["n", "label"])
    sets = [unpack5(b) for b in table.column("set").take(pa.array(order)).to_pylist()]
    found = []
    for lo, split, hi in blocks:
        sizes = np.array([len(s) for s in sets[lo:hi]])
        _, column = np.unique(np.concatenate(sets[lo:hi]), return_inverse=True)
        begin = np.cumsum(sizes) - sizes
        marked = np.zeros(column.max() + 1, np.int64)
        label = values["label"][lo:hi].copy()
        for i in range(lo, split):
            own = column[begin[i - lo]:begin[i - lo] + sizes[i - lo]]
            j = _others(values, i, split, hi) - lo
            j = j[label[j] != label[i - lo]]
            if not len(j):
                continue
            marked[own] = 1
            at = np.concatenate([np.arange(begin[k], begin[k] + sizes[k]) for k in j])
            common = np.add.reduceat(marked[column[at]], np.cumsum(sizes[j]) - sizes[j])
            marked[own] = 0
            union = sizes[i - lo] + sizes[j] - common
            for k in j[100 * common >= PERCENT * union].tolist():
                if label[k] != label[i - lo]:
                    label[label == label[k]] = label[i - lo]
                    found.append((int(values["id"][i]), int(values["id"][lo + k])))
    return pa.table({"a": pa.array([min(p) for p in found], pa.int64()),
                     "b": pa.array([max(p) for p in found], pa.int64())})


def _second_round(bands: DataFrame, hubs: DataFrame, classes: DataFrame, labels: DataFrame,
                  source: DataFrame) -> DataFrame:
    """Links between components whose members share buckets.

    A family is a component with all classes that share a bucket with a hub of it.
    Its own members (the left side) meet the others block by block, and the others
    each other. Registers drop most members of a block, and the sets of the rest
    decide, so what leaves a block is never more than its members.
    """
    of_hub = labels.select(F.col("id").alias("hub"), F.col("label").alias("hub_label"))
    member = keep(bands.join(hubs, "key").select("id", "n", "hub").distinct()
                  .join(labels, "id", "left").join(of_hub, "hub", "left")
                  .select(F.coalesce("hub_label", "hub").alias("family"), "id", "n",
                          F.coalesce("label", "id").alias("label")).distinct()
                  .withColumn("left", F.col("label") == F.col("family")), "members")
    mixed = (member.groupBy("family").agg(
        F.sum(F.col("left").cast("int")).alias("n_left"), F.sum((~F.col("left")).cast("int")).alias("n_other"))
        .filter("n_other > 0")
        .select("family", F.ceil(F.col("n_left") / BLOCK).alias("blocks"), F.ceil(F.col("n_other") / BLOCK).alias("others")))
    rows = member.join(mixed, "family")
    at = F.pmod(F.xxhash64("id"), F.when(F.col("left"), F.col("blocks")).otherwise(F.col("others")))
    # A block is (x, y): blocks of the left side count from 0 up, of the others from -1 down.
    mine = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda o: F.struct(
        F.col("at").alias("x"), (-1 - o).alias("y"), F.lit(1).alias("left")))
    facing = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
        k.alias("x"), (-1 - F.col("at")).alias("y"), F.lit(0).alias("left")))
    among = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda o: F.struct(
        (-1 - F.least(o, F.col("at"))).alias("x"), (-1 - F.greatest(o, F.col("at"))).alias("y"),
        (o < F.col("at")).cast("int").alias("left")))
    rows = keep(rows.withColumn("at", at)
                .withColumn("place", F.explode(F.when(F.col("left"), mine).otherwise(
                    F.when(F.col("blocks") > 0, F.concat(facing, among)).otherwise(among))))
                .select("family", "id", "n", "label", "place.x", "place.y", "place.left"), "places")
    groups = max(1, -(-rows.count() // GROUP_ROWS))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("family", "x", "y"), F.lit(groups)))
    live = keep(rows.join(classes.select("id", "registers"), "id")
                .groupBy("part").applyInArrow(_live_members, LIVE), "live")
    wanted = keep(live.select("id").distinct(), "wanted")
    return keep(rows.join(live, ["family", "x", "y", "id"]).join(_full_sets(source, wanted), "id")
                .groupBy("part").applyInArrow(_block_links, PAIR).distinct(), "links")


def _partners(likely: DataFrame) -> DataFrame:
    """For every class its likeliest partner, and of the likely ones that of the
    smallest id, which draws large groups together."""
    ends = (likely.select(F.col("a").alias("id"), F.col("b").alias("other"), "chance")
            .union(likely.select("b", "a", "chance")))
    chosen = ends.groupBy("id").agg(
        F.max(F.struct("chance", "other"))["other"].alias("best"),
        F.min(F.when(F.col("chance") >= PERCENT / 100, F.col("other"))).alias("root"))
    return (chosen.select("id", F.explode(F.array("best", "root")).alias("other")).filter("other is not null")
            .select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct())


def _between(likely: DataFrame, labels: DataFrame) -> DataFrame:
    """The likeliest pair of each two components that the first links left apart."""
    marked = (likely.join(labels.select(F.col("id").alias("a"), F.col("label").alias("of_a")), "a", "left")
              .join(labels.select(F.col("id").alias("b"), F.col("label").alias("of_b")), "b", "left")
              .withColumns({"of_a": F.coalesce("of_a", "a"), "of_b": F.coalesce("of_b", "b")}))
    return (marked.filter("of_a <> of_b")
            .groupBy(F.least("of_a", "of_b"), F.greatest("of_a", "of_b"))
            .agg(F.max(F.struct("chance", "a", "b")).alias("m")).select("m.a", "m.b"))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    ``component_id`` is the smallest doc_id that links reach, ``kept`` whether that is
    the row's own.
    """
    source = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    signed = keep(signatures(source), "signatures")
    classes = keep(signed.filter("n_shingles > 0").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("id"), F.any_value("n_shingles").alias("n"),
        F.any_value("registers").alias("registers")).filter("id is not null"), "classes")
    bands = _bands(classes)
    hubs = keep(bands.groupBy("key").agg(
        F.min(F.struct(F.xxhash64("key", "id").alias("turn"), "id", "n")).alias("hub"), F.count("*").alias("members"))
        .filter("members > 1").select("key", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n")), "hubs")
    first = (bands.join(hubs, "key").filter((F.col("id") != F.col("hub")) & _fits(F.col("n"), F.col("hub_n")))
             .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct())
    likely = keep(_estimated(first, classes), "likely")
    links = _verified(_partners(likely), source)
    labels = components(links)
    links = keep(links.unionByName(_verified(_between(likely, labels), source)), "links")
    labels = components(links)
    more = _second_round(bands, hubs.select("key", "hub"), classes, labels, source)
    labels = components(links.unionByName(more))
    of_class = classes.select("h1", "h2", "id").join(labels, "id", "left").select(
        "h1", "h2", F.coalesce("label", "id").alias("class_label"))
    out = signed.select("doc_id", "n_shingles", "h1", "h2").join(of_class, ["h1", "h2"], "left")
    label = F.when(F.col("n_shingles") > 0, F.col("class_label"))
    return out.select("doc_id", "n_shingles", F.coalesce(label, "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input without the documents that are not the first of their component."""
    gone = keep(near_duplicates(df, doc_id, text).filter("not kept").select(
        F.col("doc_id").alias(doc_id)).distinct(), "gone")
    small = gone.count() <= MAX_BROADCAST
    return df.join(F.broadcast(gone) if small else gone, doc_id, "left_anti").select(
        *[F.col(f"`{c}`") for c in df.columns])
