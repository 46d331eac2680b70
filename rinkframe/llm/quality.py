"""Quality rules by weak supervision.

Every rule votes good (1), bad (-1) or abstains (0) on a text. Expectation
maximisation estimates from the votes alone how often each rule is right on good
and on bad texts; the posterior probability of "good" decides. The votes of a
corpus are counted by pattern first, so the fit sees every row through at most
3**rules counts, whatever the size of the corpus.

Defined cases: a null or empty text has no words, is rejected by the base rules
and does not vote; repeated rows count as often as they stand; an empty table
gives an empty result; the columns made here replace input columns of the same
name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkframe.llm.store import free_name
from rinkframe.llm.words import SPACE, release, utf8, window_hashes

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
_CONTINUATION = bytes(range(0x80, 0xC0))
_ENDS = (b".", b"!", b"?", b'"', b":", b";")
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "n_lines", "n_ended_lines", "n_shouted")
STATS_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in _COUNTS) + ">"


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that the text has twice or more."""
    if len(words) <= size:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words), 1)}
    if len(number) > len(words) - 1:
        return 0
    ids = np.fromiter(map(number.__getitem__, words), np.uint64, len(words))
    _, which, counts = np.unique(
        window_hashes(ids, size), return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[which] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return int((np.cumsum(edges) > 0).sum())


def count_text(text: bytes) -> tuple[int, ...]:
    words = text.split()
    if not words:
        return (0,) * len(_COUNTS)
    lines = text.split(b"\n")
    n_dup = 0
    if len(set(lines)) < len(lines):
        seen = set()
        for line in lines:
            if line in seen:
                n_dup += bool(line.strip())
            seen.add(line)
    bare = [x for x in map(bytes.strip, lines) if x]
    return (
        len(words),
        len(text.translate(None, SPACE + _CONTINUATION)),
        len(text) - len(text.translate(None, SYMBOLS)),
        n_dup,
        repeated_words(words),
        len(bare),
        sum(x.endswith(_ENDS) for x in bare),
        sum(map(bytes.isupper, words)),
    )


def _measure(texts: pa.Array) -> pa.Array:
    rows = np.array([count_text(b) for b in utf8(texts)], np.int64).reshape(-1, len(_COUNTS))
    return pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(len(_COUNTS))], list(_COUNTS))


def _measures():
    @F.arrow_udf(STATS_TYPE)
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from map(_measure, batches)
        release()
    return column


def base_failed(s):
    """Fewer than 20 words, or over 30 % of them repeated in windows."""
    return (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])


def _vote(bad, good=None):
    vote = F.when(bad, F.lit(-1))
    return (vote if good is None else vote.when(good, F.lit(1))).otherwise(F.lit(0))


def votes(s) -> list:
    """One vote per rule, as columns, from the counts of a text.

    A rule that looks for one defect abstains where it finds none: lacking one
    defect says little about the others.
    """
    words, lines = s["n_words"], F.greatest(s["n_lines"], F.lit(1))
    return [
        _vote(words < 25, words >= 50),
        _vote(~(s["word_chars"] / words).between(2.5, 12)),
        _vote(s["n_symbols"] / words > 0.1, s["n_symbols"] / words < 0.02),
        _vote(s["n_dup_lines"] / lines > 0.3),
        _vote(s["n_repeat_words"] / words > 0.2),
        _vote(s["n_ended_lines"] / lines < 0.2, s["n_ended_lines"] / lines > 0.6),
        _vote(s["n_shouted"] / words > 0.5),
    ]


RULES = 7
# Rules that never vote good.
ONE_SIDED = (1, 3, 4, 6)
# Prior of a rule's accuracy on good texts, and its weight in corpora.
MOST = 0.999
PRIOR = 1.75


def _pattern(s):
    """The votes as one number, base 3."""
    code = F.lit(0)
    for v in votes(s):
        code = code * 3 + (v + 1)
    return code.cast("int")


def fit(patterns: dict[int, int], rules: int = RULES, steps: int = 60) -> dict[int, float]:
    """Posterior probability of "good" for each vote pattern.

    A two-class Dawid-Skene model: a rule that votes is right on good texts with one
    probability and on bad texts with another. Both are estimated, from 0.55 on, so a
    rule is never taken for its opposite, and the share of good texts within 0.1
    and 0.9, so that a corpus of one kind still has a defined answer. A rule that only
    looks for a defect is right on a good text when it abstains. The prior says that a
    rule is right on 99.9 % of good texts, with the weight of ``PRIOR`` corpora: a rule
    has to be at odds with the others on a large share of a corpus to lose trust.
    """
    if not patterns:
        return {}
    codes = np.array(sorted(patterns))
    weight = np.array([patterns[c] for c in codes], float)
    v = (codes[:, None] // 3 ** np.arange(rules - 1, -1, -1)) % 3 - 1
    up, down = (v == 1).astype(float), (v == -1).astype(float)
    right = np.where(np.isin(np.arange(rules), ONE_SIDED) & (v == 0), 1.0, up)
    prior = 2 + PRIOR * weight.sum()
    on_good, on_bad, share = np.full(rules, MOST), np.full(rules, 0.75), 0.7
    for _ in range(steps):
        good = np.log(share) + up @ np.log(on_good) + down @ np.log(1 - on_good)
        bad = np.log(1 - share) + up @ np.log(1 - on_bad) + down @ np.log(on_bad)
        p = 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))
        a, b = weight * p, weight * (1 - p)
        on_good = np.clip((a @ right + MOST * prior) / (a @ (right + down) + prior), 0.55, MOST)
        on_bad = np.clip((b @ down + 1) / (b @ (up + down) + 2), 0.55, 0.99)
        share = float(np.clip(a.sum() / weight.sum(), 0.1, 0.9))
    return dict(zip(codes.tolist(), p.tolist()))


def judge(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the struct ``quality``: counts, base verdict, posterior and ``kept``.

    Two passes over the texts and no shuffle of them: the first counts vote
    patterns, the second looks the posterior of each row's pattern up. The table of
    posteriors has at most 3**7 rows, so broadcasting it is safe at any size.
    """
    measured = df.withColumn("quality", _measures()(F.col(text)))
    s = F.col("quality")
    counted = (measured.filter(~base_failed(s))
               .groupBy(_pattern(s).alias("pattern")).count().collect())
    posterior = fit({r["pattern"]: r["count"] for r in counted})
    code, pattern, chance = (free_name(df, c) for c in ("code", "pattern", "posterior"))
    table = df.sparkSession.createDataFrame(
        [(int(k), float(p)) for k, p in posterior.items()], f"`{pattern}` int, `{chance}` double")
    failed = base_failed(s)
    joined = (measured
              .withColumn(code, F.when(~failed, _pattern(s)))
              .join(F.broadcast(table), F.col(code) == F.col(pattern), "left"))
    good = F.coalesce(F.col(chance), F.lit(0.0))
    full = F.struct(
        *[s[c].alias(c) for c in _COUNTS],
        failed.alias("base_failed"),
        good.alias("posterior"),
        (~failed & (good >= 0.5)).alias("kept"),
    )
    return joined.withColumn("quality", full).drop(code, pattern, chance)


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text is kept, with the columns of the input."""
    row, text_column = F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.col(f"`{text}`")
    packed = df.select(row.alias("row"), text_column.alias("text"))
    return judge(packed).filter(F.col("quality.kept")).select("row.*")
