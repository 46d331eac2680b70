"""Alignment of the tokens of two tokenizers over whole documents.

Both tokenizers run over the whole text. Wherever a space-marked token starts in both
at one byte offset, everything before has ended in both too; such anchors split a
document into windows of token ids, mostly a word long. Windows repeat, so the
alignment of a window (its groups and links) is remembered by its ids. Links are then
counted over the corpus and every document's links are judged by these counts.

Defined cases: a null or empty text, and one whose tokens do not give back its bytes,
has no tokens and zeros; a text without spaces is one window, aligned in one pass over
its tokens; repeated rows are aligned each for itself and count each; an empty table
gives no rows. Only ``doc_id`` and the text column are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkframe.llm.store import keep

# Texts of about this many characters are aligned together.
GROUP_CHARS = 1_000_000
# Windows remembered by a task, and the longest that is (in tokens of both sides).
REMEMBERED = 200_000
LONGEST = 64
# Added to the ids of b where ids of both sides stand together.
MARK = 1 << 24
# Counted pairs that are broadcast at once; more come in several passes.
BROADCAST_PAIRS = 2_000_000

ALIGNED = ("row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
           "groups string, pairs array<bigint>, times array<int>")

# Splits text before byte-level merges; a fixed part of the vocabulary's format.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_letter() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, reversed.

    Printable Latin-1 characters stand for themselves, the others for code points from
    256 on, in order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteTokens:
    """A byte-level BPE vocabulary file; special tokens in texts are plain text.

    If every merge makes the token whose id is next, ids are ranks and the faster of two
    libraries that then agree does the work; else the file's own library does.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, letters = whole["model"], byte_of_letter()
        special = {t["id"] for t in whole["added_tokens"] if t["special"]}
        self.pieces = [b""] * (max([*model["vocab"].values(), *special]) + 1)
        for token, i in model["vocab"].items():
            if i not in special:
                self.pieces[i] = bytes(letters[c] for c in token)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ranked = all(model["vocab"].get(a + b) == 256 + k for k, (a, b) in enumerate(merges))
        plain = whole["normalizer"] is None and whole["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        known = {p: i for i, p in enumerate(self.pieces) if p}
        if ranked and plain and len(known) == 256 + len(merges):
            import tiktoken

            coder = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=known, special_tokens={})
            self.encode = lambda texts: [coder.encode_ordinary(t) for t in texts]
        else:
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            own.encode_special_tokens = True
            self.encode = lambda texts: [
                e.ids for e in own.encode_batch_fast(texts, add_special_tokens=False)]


class PieceTokens:
    """A sentencepiece model that puts a space in front of a text."""

    def __init__(self, path: str):
        import sentencepiece

        coder = sentencepiece.SentencePieceProcessor(model_file=path)
        self.encode = lambda texts: coder.encode(texts, num_threads=1)
        self.pieces: list[bytes] = []
        for i in range(coder.get_piece_size()):
            piece = coder.id_to_piece(i)
            if coder.is_byte(i):
                self.pieces.append(bytes([int(piece[3:5], 16)]))
            else:
                self.pieces.append(piece.replace("▁", " ").encode())


def side_size(b_path: str) -> int:
    """Size of the vocabulary b, which a pair's number needs."""
    return len(PieceTokens(b_path).pieces)


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(ByteTokens(a_path), PieceTokens(b_path))


class Side:
    """The pieces of one vocabulary as flat arrays."""

    def __init__(self, coder, separators: list[bytes]):
        self.encode = coder.encode
        self.sizes = np.array([len(p) for p in coder.pieces], np.int64)
        self.marked = np.array([p[:1] == b" " for p in coder.pieces])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(coder.pieces), np.uint8)
        # An id as decimal text, once with every separator that can follow.
        self.shown = [b"%d%s" % (i, c) for c in separators for i in range(len(coder.pieces))]

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all pieces, end to end."""
        sizes = self.sizes[ids]
        return self.data[np.repeat(self.starts[ids] - np.cumsum(sizes) + sizes, sizes)
                         + np.arange(sizes.sum())]


class Aligner:
    """Aligns the tokens ``a`` of space+text with the tokens ``b`` of the text."""

    def __init__(self, a, b):
        self.a, self.b = Side(a, [b",", b"|"]), Side(b, [b",", b";", b""])
        self.width = len(self.b.sizes)
        self.table = self.a.shown + self.b.shown
        self.memo: dict[bytes, tuple[bytes, bytes]] = {}

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides; None where one does not give back its text."""
        want = [(" " + t).encode() for t in texts]
        coded = self.a.encode([" " + t for t in texts]), self.b.encode(texts)
        right = np.full(len(texts), True)
        split = []
        for side, ids in zip((self.a, self.b), coded):
            bounds = np.cumsum([0] + [len(i) for i in ids])
            flat = np.fromiter(chain.from_iterable(ids), np.int64, bounds[-1])
            spelled, ends = side.spelled(flat).tobytes(), np.append(0, np.cumsum(side.sizes[flat]))[bounds]
            if spelled != b"".join(want) or (np.diff(ends) != [len(w) for w in want]).any():
                right &= [spelled[s:e] == w for s, e, w in zip(ends, ends[1:], want)]
            split.append(np.split(flat, bounds[1:-1]))
        return [(x, y) if r else None for x, y, r in zip(*split, right)]

    def solve(self, windows: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Groups as text and linked pairs of every window of ids.

        All windows are laid end to end along their bytes, which are the same on both
        sides. Between two neighbouring ends of any token lies one link; where tokens of
        both sides end, so does a group.
        """
        merged = np.frombuffer(b"".join(windows), np.uint32).astype(np.int64)
        in_b = merged >= MARK
        sides, ids = (self.a, self.b), (merged[~in_b], merged[in_b] - MARK)
        last = [np.cumsum(s.sizes[i]) - 1 for s, i in zip(sides, ids)]  # byte a token ends on
        ended = [np.zeros(int(last[0][-1]) + 1, np.int64) for _ in sides]
        for mark, at in zip(ended, last):
            mark[at] = 1
        cut, common = ended[0] | ended[1], ended[0] & ended[1]
        at = np.flatnonzero(cut)
        a_of, b_of = [(np.cumsum(mark) - mark)[at] for mark in ended]
        pairs = (ids[0][a_of] * self.width + ids[1][b_of]).tobytes()
        # Tokens in the order of groups, those of a first, each shown with what follows it.
        group = [(np.cumsum(common) - common)[x] for x in last]
        size = [np.bincount(g) for g in group]
        place = [np.arange(len(group[0])) + (np.cumsum(size[1]) - size[1])[group[0]],
                 np.arange(len(group[1])) + np.cumsum(size[0])[group[1]]]
        ends = [np.append(np.diff(g) > 0, True) for g in group]
        tokens = np.cumsum([len(w) // 4 for w in windows])
        closes = np.zeros(len(merged), bool)
        closes[tokens - 1] = True
        follows = [ends[0].astype(np.int64), ends[1] + closes[place[1]].astype(np.int64)]
        order = np.empty(len(merged), np.int64)
        order[place[0]] = ids[0] + follows[0] * len(self.a.sizes)
        order[place[1]] = ids[1] + follows[1] * len(self.b.sizes) + len(self.a.shown)
        shown = [self.table[k] for k in order.tolist()]
        upto = np.cumsum(cut)[last[1][np.cumsum(in_b)[tokens - 1] - 1]]
        t, c = [0, *tokens.tolist()], [0, *(8 * upto).tolist()]
        for k in range(len(windows)):
            yield b"".join(shown[t[k]:t[k + 1]]), pairs[c[k]:c[k + 1]]

    def align(self, texts: list[str | None]) -> Iterator[tuple]:
        """``n_a, n_b, groups, pairs, times`` of every text, in order."""
        coded = iter(self.tokens([t for t in texts if t]) if any(texts) else [])
        ids = [next(coded) if t else None for t in texts]
        kept = [x for x in ids if x is not None]
        windows = list(self._windows(kept)) if kept else []
        new = list(set().union(*windows).difference(self.memo))
        if new:
            self.memo.update(zip(new, self.solve(new)))
        queue = iter(windows)
        for x in ids:
            if x is None:
                yield 0, 0, b"", np.empty(0, np.int64), np.empty(0, np.int64)
                continue
            found = [self.memo[w] for w in next(queue)]
            links = np.frombuffer(b"".join([f[1] for f in found]), np.int64)
            pairs, times = np.unique(links, return_counts=True)
            yield len(x[0]), len(x[1]), b";".join([f[0] for f in found]), pairs, times
        if len(self.memo) > REMEMBERED:
            self.memo.clear()
        for w in new:
            if len(w) > 4 * LONGEST:
                self.memo.pop(w, None)

    def _windows(self, kept: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[list[bytes]]:
        """The ids of every window of every document: those of a, then those of b.

        All documents are cut at once: they are laid end to end, and each begins with a
        space-marked token on both sides.
        """
        sides, flat = (self.a, self.b), [np.concatenate([x[k] for x in kept]) for k in (0, 1)]
        sizes = [s.sizes[i] for s, i in zip(sides, flat)]
        starts = [np.cumsum(n) - n for n in sizes]
        shared = [np.zeros(int(sizes[0].sum()), bool) for _ in sides]
        for k in (0, 1):
            shared[k][starts[k][sides[k].marked[flat[k]]]] = True
        anchors = shared[0] & shared[1]  # by byte
        bounds = [np.append(np.flatnonzero(anchors[starts[k]]), len(flat[k])) for k in (0, 1)]
        # A window's tokens of a stand before its tokens of b.
        merged = np.empty(len(flat[0]) + len(flat[1]), np.uint32)
        merged[np.arange(len(flat[0])) + np.repeat(bounds[1][:-1], np.diff(bounds[0]))] = flat[0]
        merged[np.arange(len(flat[1])) + np.repeat(bounds[0][1:], np.diff(bounds[1]))] = flat[1] + MARK
        data, cuts = merged.tobytes(), (4 * (bounds[0] + bounds[1])).tolist()
        first = np.cumsum([0] + [len(x[0]) for x in kept])
        begins = np.searchsorted(bounds[0], first).tolist()
        for i, j in zip(begins, begins[1:]):
            yield [data[s:e] for s, e in zip(cuts[i:j], cuts[i + 1:j + 1])]


def _grouped(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    begin, n = 0, 0
    for k, t in enumerate(texts, 1):
        n += len(t or "")
        if n >= GROUP_CHARS or k == len(texts):
            yield begin, k
            begin, n = k, 0


def align(df: DataFrame, a_path: str, b_path: str, *, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Groups and linked pairs of every document, in one pass without a shuffle.

    ``a_path`` is a byte-level BPE file of ``tokenizers`` and ``b_path`` a sentencepiece
    model, on every executor. ``groups`` is ``a1,a2|b1;a3|b2,b3``: ids of both sides in
    order, cut where tokens of both end. ``pairs`` are the distinct linked pairs as
    ``a * (size of b) + b``, ``times`` how many links each is. ``row`` is one number a row.
    """
    def run(batches):
        work = aligner(a_path, b_path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in _grouped(texts):
                out = list(work.align(texts[i:j]))
                offsets = pa.array(np.cumsum([0] + [len(o[3]) for o in out]), pa.int32())
                lists = [np.concatenate([o[c] for o in out]) for c in (3, 4)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("row").slice(i, j - i), batch.column("doc_id").slice(i, j - i),
                    pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                    pa.array([o[2].count(b";") + 1 if o[0] else 0 for o in out], pa.int64()),
                    pa.array([int(o[4].sum()) for o in out], pa.int64()),
                    pa.array([o[2] for o in out], pa.binary()).cast(pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(lists[0], pa.int64())),
                    pa.ListArray.from_arrays(offsets, pa.array(lists[1].astype(np.int32), pa.int32())),
                ], [c.split()[0] for c in ALIGNED.split(", ")])

    source = df.select(F.monotonically_increasing_id().alias("row"),
                       F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``pair, total, is_best`` over all documents; ``width`` is the size of b.

    ``is_best``: no other pair of that b has more links. The best counts are one row an
    id of b, so the vocabulary bounds what is broadcast.
    """
    links = aligned.select(F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
    totals = keep(links.groupBy("pair").agg(F.sum("times").alias("total")), "pair-totals")
    totals = totals.withColumn("b", F.col("pair") % width)
    best = totals.groupBy("b").agg(F.max("total").alias("most"))
    return totals.join(F.broadcast(best), "b").select(
        "pair", "total", (F.col("total") == F.col("most")).cast("int").alias("is_best"))


def judge_links(aligned: DataFrame, width: int, at_once: int = BROADCAST_PAIRS) -> DataFrame:
    """``row, n_best, count_sum`` of every document that has links.

    ``aligned`` must be stored (it is read several times). The counted pairs are
    broadcast, ``at_once`` at most; a corpus with more takes a pass over the stored pairs
    for every such share. A pair is never a shuffle key, as the commonest stand in nearly
    all documents.
    """
    counted = keep(pair_counts(aligned, width), "pair-counts")
    shares = max(1, -(-counted.count() // (at_once * 3 // 4)))
    links = aligned.select("row", F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
    share = F.pmod(F.xxhash64("pair"), F.lit(shares))
    sums = None
    for k in range(shares):
        part = links.filter(share == k).join(F.broadcast(counted.filter(share == k)), "pair")
        part = part.groupBy("row").agg(F.sum(F.col("times") * F.col("is_best")).alias("n_best"),
                                       F.sum(F.col("times") * F.col("total")).alias("count_sum"))
        sums = part if sums is None else sums.unionByName(part)
    if shares > 1:
        sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return sums
