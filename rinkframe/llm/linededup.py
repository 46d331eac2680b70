"""Line dedup by a segment-partition edit join, in DataFrame operations only.

A line goes if an equal line, or one within ``EDITS`` edits, stands earlier in the
corpus (by doc_id and place). Two lines within e edits share one of e + 1 segments
of the shorter one, at a place that their lengths bound, so every distinct line is
indexed by its own segments and probes the substrings that could be another's.
Candidates must have similar letter counts, and are verified by banded bit-parallel
edit distance.

Lines of fewer than ``LEAST_CHARS`` characters take part if ``least_chars`` says so,
with a smaller budget: one edit from ``LEAST_CHARS / EDITS`` characters on, none below.

Defined cases: a null text has no lines and comes back empty; lines of fewer than
``least_chars`` characters, and blank ones below ``LEAST_CHARS``, are always kept;
repeated rows keep the same lines; a null doc_id comes first; an empty table gives an empty result. Of the input columns only
the text is changed; ``lines`` is added and replaces a column of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rinkframe.llm.store import free_name, keep

EDITS = 2
LEAST_CHARS = 30
# Key tables up to this number of rows (16 bytes each) are broadcast.
MAX_BROADCAST = 500_000
# Bytes of a character in UTF-32.
WIDE = 4
# From this length on, lines are cut as the next shorter multiple of the step is, so that lines
# a few characters apart mostly have segments of one size and probe no others.
STEP_FROM, STEP = 64, 16
# Pieces that are looked for before the edit distance is computed.
PIECES = 8
PROBE = ("edits", "less", "part", "shift", "own", "again")
# Bit of the lowest diagonal in the bit vectors of the edit distance.
TOP = 40
# Letters whose counts are compared before texts are fetched.
LETTERS = "etaoinsrhlducmfgpwybvkqz,. éèêñüöäßçíó#*"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _probes(edits: int) -> list[tuple[int, int, int, int, bool, bool]]:
    """``edits, less, part, shift, own, again`` of a line's keys: its own segments, and the
    places where a line shorter by ``less`` could have its segments. ``again``: a line shorter
    by one less has the same key, if it has segments of the same size."""
    def shifts(less, i):
        return range(max(-i, less - (edits - i)), min(i, less + edits - i) + 1)
    own = [(edits, 0, i, 0, True, False) for i in range(edits + 1)]
    return own + [(edits, less, i, shift, False, less > 0 and (i == edits or shift in shifts(less - 1, i)))
                  for less in range(edits + 1) for i in range(edits + 1)
                  for shift in shifts(less, i) if less or shift]


def _round(l: Column) -> Column:
    """The length that the segments of a line of ``l`` characters are sized by."""
    return F.when(l < STEP_FROM, l).otherwise(l - l % STEP)


def _budget(n: Column, edits: int) -> Column:
    """Edits allowed where the shorter of two lines has ``n`` characters."""
    return F.when(n >= LEAST_CHARS, edits).otherwise(F.floor(n * edits / LEAST_CHARS)).cast("int")


def _budgeted_probes(n: Column, edits: int, least: int) -> Column:
    """The probes of a line of ``n`` characters, as one of a few constant arrays. A line just
    longer than where a budget ends probes the shorter ones below with theirs."""
    bounds = [(e, -(-LEAST_CHARS * e // edits), -(-LEAST_CHARS * (e + 1) // edits) + e)
              for e in range(1, edits) if least < LEAST_CHARS] + [(edits, LEAST_CHARS, None)]
    at = F.lit(None)
    for low in sorted({x for _, *ends in bounds for x in ends if x is not None}):
        probes = [p for e, start, end in bounds if start <= low and (end is None or low < end) for p in _probes(e)]
        fixed = F.array(*[F.struct(*[F.lit(x).alias(c) for c, x in zip(PROBE, p)]) for p in probes])
        at = F.when(n >= low, fixed).otherwise(at)
    return at


def key_rows(lines: DataFrame, edits: int = EDITS, least: int = LEAST_CHARS) -> DataFrame:
    """``h1, h2, n, key, own``: own segments (``own`` true) and probed substrings of the
    lines, as hashed keys, and the lines' lengths.

    The last of the ``edits + 1`` segments ends with the line, the others stand side by side
    from its start; what is left lies before the last one.
    """
    # At four bytes a character a segment is cut out without counting from the line's start.
    wide = lines.select("h1", "h2", F.encode("line", "UTF-32").alias("wide"))
    rows = (wide.withColumn("n", (F.octet_length("wide") / WIDE).cast("int"))
            .select("*", F.inline(_budgeted_probes(F.col("n"), edits, least)))
            .withColumn("l", F.col("n") - F.col("less")))
    rows = rows.withColumn("size", _round(F.col("l"))).filter(
        ~F.col("again") | (_round(F.col("l") + 1) != F.col("size")))
    chars = F.floor(F.col("size") / (F.col("edits") + 1)).cast("int")
    before = F.when(F.col("part") == F.col("edits"), F.col("n") - chars).otherwise(
        F.col("part") * chars + F.col("shift"))
    segment = F.substr("wide", before * WIDE + 1, chars * WIDE)
    return rows.select("h1", "h2", "n", F.xxhash64("size", "part", segment).alias("key"), "own")


def letter_counts(line: Column) -> Column:
    """Counts of common letters, in their order. One edit changes two of them by one."""
    n = F.length(line)
    return F.array(*[(n - F.length(F.replace(line, F.lit(c), F.lit("")))).cast("int") for c in LETTERS])


def _odd_letters(letters: Column) -> Column:
    """A bit for each letter that stands an odd number of times."""
    bits = F.lit(0).cast("bigint")
    for k in range(len(LETTERS)):
        bits = bits.bitwiseOR(F.shiftleft((F.get(letters, F.lit(k)) % 2).cast("bigint"), k))
    return bits


def _counts_apart(a: Column, b: Column) -> Column:
    total = F.lit(0)
    for k in range(len(LETTERS)):
        total = total + F.abs(F.get(a, F.lit(k)) - F.get(b, F.lit(k)))
    return total


def edit_distance(a: Column, b: Column, n_a: Column, edits: int = EDITS) -> Column:
    """Edit distance of two arrays of characters, exact where it is at most ``edits``.

    Bit vectors hold the vertical differences of the dynamic programme in a band of
    ``2 * edits + 1`` diagonals. Bit ``TOP`` is row ``j + edits`` of column ``j``; the score
    follows the band's lowest diagonal and then the last row. Lengths may differ by
    ``edits`` at most, and both exceed it.
    """
    # What a lambda refers to is computed again for every element, so the arrays come as a value.
    return _let(F.struct(a.alias("a"), b.alias("b"), n_a.alias("n")),
                lambda v: _band_score(v["a"], v["b"], v["n"], edits))


def _band_score(a: Column, b: Column, n_a: Column, edits: int) -> Column:
    def equal_bits(c, j):
        bits = F.lit(0).cast("bigint")
        for k in range(2 * edits + 1):
            bit = F.lit(1 << (TOP - k)).cast("bigint")
            at = j + (edits - k)
            bits = bits.bitwiseOR(F.when(F.get(a, at) == c, bit).otherwise(F.lit(0).cast("bigint")))
        return F.struct(bits.alias("eq"), j.alias("j"))

    def inside(v):
        return v.bitwiseAND(F.lit((2 << TOP) - 1))

    def bit(v, at):
        return F.call_function("shiftrightunsigned", v, at).bitwiseAND(F.lit(1).cast("bigint"))

    def step(s, x):
        eq, vp, vn = x["eq"], s["vp"], s["vn"]
        d0 = inside((eq.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(eq).bitwiseOR(vn))

        def after_d0(d):
            def after_horizontal(h):
                hp, hn, down = h["hp"], h["hn"], F.shiftrightunsigned(d, 1)
                on_diagonal = x["j"] < n_a - edits
                at = (TOP - 1 - (x["j"] - (n_a - edits))).cast("int")
                more = F.when(on_diagonal, 1 - bit(d, F.lit(TOP))).otherwise(
                    bit(hp, at) - bit(hn, at))
                return F.struct(
                    inside(hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp)))).alias("vp"),
                    down.bitwiseAND(hp).alias("vn"), (s["score"] + more).alias("score"))
            return _let(F.struct(inside(vn.bitwiseOR(F.bitwise_not(d.bitwiseOR(vp)))).alias("hp"),
                                 d.bitwiseAND(vp).alias("hn")), after_horizontal)
        return _let(d0, after_d0)

    begin = F.struct(F.lit(((2 << edits) - 1) << (TOP - edits)).cast("bigint").alias("vp"),
                     F.lit(0).cast("bigint").alias("vn"), F.lit(edits).cast("bigint").alias("score"))
    return F.aggregate(F.transform(b, equal_bits), begin, step)["score"]


def _pieces_missing(a: Column, b: Column) -> Column:
    """How many of ``PIECES`` pieces of ``a`` do not stand in ``b``. One edit changes one piece."""
    size = F.floor(F.length(a) / PIECES).cast("int")
    missing = F.lit(0)
    for k in range(PIECES):
        missing = missing + (~F.contains(b, F.substr(a, size * k + 1, size))).cast("int")
    return missing


def _characters(line: Column) -> Column:
    return F.split(line, "")


def _small(df: DataFrame):
    return F.broadcast(df) if df.count() <= MAX_BROADCAST else df


def _takes_part(line: Column, least: int) -> Column:
    long = F.length(line) >= least
    return long if least >= LEAST_CHARS else long & ((F.length(line) >= LEAST_CHARS) | line.rlike(r"\S"))


def _all_lines(df: DataFrame, doc_id: str, text: str, least: int) -> DataFrame:
    """``doc, version, at, line`` and the line's two hashes, for lines that take part."""
    parts = df.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("version"),
                      F.split(F.col(text), "\n").alias("parts"))
    # The outer form, as the other makes Spark split every text three times to leave out empty ones.
    return (parts.select("doc", "version", F.posexplode_outer("parts").alias("at", "line"))
            .filter(_takes_part(F.col("line"), least))
            .withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line")}))


def _owner() -> Column:
    """Whether a row is of a line's own segment, under the line's own length."""
    return F.col("own") & (F.col("less") == 0)


def near_lines(lines: DataFrame, edits: int = EDITS, least: int = LEAST_CHARS) -> tuple[DataFrame, DataFrame]:
    """First places of lines that stand in several, and the lines that are near an earlier one."""
    distinct = keep(lines.groupBy("h1", "h2").agg(
        F.min(F.struct("doc", "version", "at")).alias("first"), F.count("*").alias("places"),
        F.any_value("line").alias("line")), "lines")
    rows = keep(key_rows(distinct, edits, least), "segments")
    met = keep(rows.groupBy("key").agg(F.count("*").alias("n"), F.max("own").alias("own"))
               .filter("n > 1 and own").select("key"), "keys")
    # Lines meet by a key and the length of the shorter one.
    rows = keep(rows.join(_small(met), "key", "left_semi")
                .select("*", F.explode(F.array(*[F.lit(k) for k in range(edits + 1)])).alias("less"))
                .withColumn("of_n", F.col("n") - F.col("less")), "meetings")
    met = keep(rows.groupBy("key", "of_n").agg(F.count("*").alias("n"), F.max(_owner()).alias("own"))
               .filter("n > 1 and own").select("key", "of_n"), "keys")
    rows = rows.join(_small(met), ["key", "of_n"], "left_semi")
    # Only lines that meet another are counted.
    wanted = keep(rows.select("h1", "h2").distinct(), "wanted")
    texts = keep(distinct.join(_small(wanted), ["h1", "h2"], "left_semi")
                 .select("h1", "h2", "first", "line", letter_counts(F.col("line")).alias("letters"))
                 .withColumn("odd", _odd_letters(F.col("letters"))), "texts")
    rows = rows.join(texts.select("h1", "h2", "first", "letters", "odd"), ["h1", "h2"])

    def met_as(k):
        return [F.col(c).alias(f"{k}_{c}") for c in ("key", "of_n", "h1", "h2", "first", "letters", "odd")]
    a = rows.filter(_owner()).select(*met_as("a"))
    b = rows.select(_owner().alias("owner"), *met_as("b"))
    same_side = F.col("owner") & (F.struct("a_h1", "a_h2") >= F.struct("b_h1", "b_h2"))
    pairs = keep(a.join(b, (F.col("a_key") == F.col("b_key")) & (F.col("a_of_n") == F.col("b_of_n")) & ~same_side
                        & ((F.col("a_h1") != F.col("b_h1")) | (F.col("a_h2") != F.col("b_h2")))
                        & (F.bit_count(F.col("a_odd").bitwiseXOR(F.col("b_odd"))) <= 2 * edits)
                        & (_counts_apart(F.col("a_letters"), F.col("b_letters")) <= 2 * edits))
                 .select("a_h1", "a_h2", "b_h1", "b_h2", (F.col("a_first") < F.col("b_first")).alias("a_is_first"))
                 .distinct(), "pairs")

    def side(k):
        return texts.select(F.col("h1").alias(f"{k}_h1"), F.col("h2").alias(f"{k}_h2"), F.col("line").alias(k))
    read = pairs.join(side("a"), ["a_h1", "a_h2"]).join(side("b"), ["b_h1", "b_h2"])
    distance = edit_distance(_characters(F.col("a")), _characters(F.col("b")), F.length("a"), edits)
    allowed = _budget(F.least(F.length("a"), F.length("b")), edits)
    near = (read.filter(_pieces_missing(F.col("a"), F.col("b")) <= edits).filter(distance <= allowed)
            .select(F.when(F.col("a_is_first"), F.col("b_h1")).otherwise(F.col("a_h1")).alias("h1"),
                    F.when(F.col("a_is_first"), F.col("b_h2")).otherwise(F.col("a_h2")).alias("h2"))
            .distinct().withColumn("near", F.lit(True)))
    return distinct.filter("places > 1").select("h1", "h2", "first"), near


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: int = EDITS,
                least_chars: int = LEAST_CHARS) -> DataFrame:
    """The input with repeated lines taken out of the text, and the struct ``lines``:
    ``total``, ``removed`` and ``long_left`` (lines that take part and stay)."""
    doc, version, gone_at = (free_name(df, c) for c in ("doc", "version", "gone"))
    lines = _all_lines(df, doc_id, text, least_chars)
    first, near = near_lines(lines, edits, least_chars)
    fate = first.join(near, ["h1", "h2"], "full")
    gone = (lines.select("doc", "version", "at", "h1", "h2").join(fate, ["h1", "h2"])
            .withColumn("repeated", ~F.col("first").eqNullSafe(F.struct("doc", "version", "at")))
            .filter(F.col("repeated") | F.col("near"))
            .groupBy(F.col("doc").alias(doc), F.col("version").alias(version))
            .agg(F.collect_set("at").alias(gone_at)))
    split = F.split(F.col(text), "\n")
    left = _let(split, lambda parts: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone_at)), lambda i: F.get(parts, i)))
    # Hashing the few numbers of ``gone`` spares sorting whole documents.
    marked = df.join(gone.hint("shuffle_hash"), F.col(doc_id).eqNullSafe(F.col(doc))
                     & F.xxhash64(text).eqNullSafe(F.col(version)), "left")
    kept = F.when(F.col(gone_at).isNull(), split).otherwise(left)
    out = marked.withColumn("lines", F.struct(
        F.coalesce(F.size(split), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.size(gone_at), F.lit(0)).cast("bigint").alias("removed"),
        F.coalesce(F.size(F.filter(kept, lambda l: _takes_part(l, least_chars))), F.lit(0))
        .cast("bigint").alias("long_left")))
    rest = F.when(F.col(gone_at).isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    return out.withColumn(text, F.coalesce(rest, F.lit(""))).drop(gone_at, doc, version)


def keep_distinct_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                        least_chars: int = LEAST_CHARS) -> DataFrame:
    """The input with repeated lines taken out; a document that loses lines and keeps
    none that takes part goes."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    out = dedup_lines(df.select(row.alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                      least_chars=least_chars)
    kept = out.filter((F.col("lines.removed") == 0) | (F.col("lines.long_left") > 0))
    return kept.select(F.col("row").withField(text, F.col("text")).alias("row")).select("row.*")
