"""Benchmark decontamination with the q-gram lemma.

A stretch of ``REGION`` characters with at most e edits still shares
``REGION + 1 - Q - Q * e`` q-grams with its source, all on neighbouring diagonals.
The q-grams of a text that a benchmark item has are counted in overlapping bands of
diagonals; stretches that reach the bound are verified by banded alignment. Texts
are compared lower-cased, with every run of other characters than letters and digits
as one space.

Defined cases: a null text is empty and leaks nothing; an item of fewer than
``LEAST_ITEM`` normalised characters is too common to tell and never matches; an item
shorter than ``REGION`` must be found whole; repeated rows are searched each for
itself and repeated items are all named; empty tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkframe.llm.store import keep
from rinkframe.llm.words import lean, mix, odd_numbers, utf8

Q = 12
REGION = 80
# One edit in so many characters is allowed.
CHARS_PER_EDIT = 30
LEAST_ITEM = 25
# Benchmark text that is held and broadcast at once; a larger benchmark is searched
# in several passes, each with its own part.
MAX_BYTES = 16_000_000
# Ids up to this number (8 MB) are broadcast; more are joined by shuffle.
MAX_BROADCAST = 1_000_000
TABLE_BITS = 22
CHUNK = 1 << 18
OVERLAP = 512

_PLAIN = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_B = odd_numbers(5, 12)
LEAKS = "row bigint, item_id bigint, regions bigint, chars bigint, edits bigint"


def normalised(text: bytes) -> bytes:
    if not text.isascii():
        text = text.decode().lower().encode()
    return b" ".join(text.lower().translate(_PLAIN).split())


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``Q`` bytes at each place."""
    h = (text.astype(np.uint64) + np.uint64(1)) * _B[0]
    h = h[:-1] * _B[1] + h[1:]
    four = h[:-2] * _B[2] + h[2:]
    eight = four[:-4] * _B[3] + four[4:]
    return mix(eight[:-4] * _B[4] + four[8:])


def aligned_edits(window: bytes, text: bytes, edits: int) -> int:
    """Least edits that turn ``window`` into some stretch of ``text``, or ``edits + 1``.

    Rows are the window's bytes; the text is short (a window and its slack), so the
    band is all of it. Ends in the text are free.
    """
    if window in text:
        return 0
    t = np.frombuffer(text, np.uint8)
    n = len(t)
    ramp = np.arange(n + 1)
    row = np.zeros(n + 1, np.int64)
    for c in window:
        step = np.empty(n + 1, np.int64)
        step[0] = row[0] + 1
        step[1:] = np.minimum(row[:-1] + (t != c), row[1:] + 1)
        row = np.minimum.accumulate(step - ramp) + ramp
        if row.min() > edits:
            return edits + 1
    return int(min(row.min(), edits + 1))


@dataclass
class Index:
    """The q-grams of benchmark items, sorted, and a bit table in front of them."""

    items: list[tuple[int, bytes]]  # id and normalised text

    def __post_init__(self):
        hashes, item, at = [], [], []
        for k, (_, text) in enumerate(self.items):
            h = gram_hashes(np.frombuffer(text, np.uint8))
            hashes.append(h)
            item.append(np.full(len(h), k))
            at.append(np.arange(len(h)))
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        turn = np.argsort(h, kind="stable")
        h = h[turn]
        self.item = (np.concatenate(item) if item else np.empty(0, np.int64))[turn]
        self.at = (np.concatenate(at) if at else np.empty(0, np.int64))[turn]
        first = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.empty(0, bool)
        self.grams, self.begin = h[first], np.append(np.flatnonzero(first), len(h))
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self._slot(self.grams)] = True
        sizes = np.array([len(t) for _, t in self.items], np.int64)
        self.region = np.minimum(sizes, REGION)
        self.edits = self.region // CHARS_PER_EDIT
        self.bound = self.region + 1 - Q - Q * self.edits

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def hits(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in a text, items and places in them, for every shared q-gram."""
        h = gram_hashes(text)
        place = np.flatnonzero(self.table[self._slot(h)])
        h = h[place]
        at = np.minimum(np.searchsorted(self.grams, h), len(self.grams) - 1)
        same = self.grams[at] == h
        place, at = place[same], at[same]
        times = self.begin[at + 1] - self.begin[at]
        entry = np.repeat(self.begin[at], times) + np.arange(times.sum()) - np.repeat(
            np.cumsum(times) - times, times)
        return np.repeat(place, times), self.item[entry], self.at[entry]

    def leaks(self, pieces: list[tuple[int, int, bytes]]) -> dict[tuple[int, int], list]:
        """Verified windows per (row, item) in a chunk of texts: start in the item,
        diagonal, slice of the text and its place."""
        body = b"\1".join(p for *_, p in pieces)
        found: dict[tuple[int, int], list] = {}
        if len(body) < Q or not len(self.grams):
            return found
        starts = np.cumsum([0] + [len(p) + 1 for *_, p in pieces])
        place, item, at = self.hits(np.frombuffer(body, np.uint8))
        # Most hits are chance: an item needs as many in a text as its bound.
        piece = np.searchsorted(starts, place, side="right") - 1
        pair = piece * len(self.items) + item
        _, which, counts = np.unique(pair, return_inverse=True, return_counts=True)
        enough = counts[which] >= self.bound[item] if len(pair) else np.empty(0, bool)
        place, item, at, piece = place[enough], item[enough], at[enough], piece[enough]
        diagonal = place - at
        step = self.edits[item] + 1
        # Band k holds two steps of diagonals from k * step on, so each lies in two.
        low = diagonal // step
        piece, item, at, diagonal = (np.concatenate((x, x)) for x in (piece, item, at, diagonal))
        band = np.concatenate((low, low - 1))
        turn = np.lexsort((at, band, item, piece))
        piece, item, at, diagonal, band = piece[turn], item[turn], at[turn], diagonal[turn], band[turn]
        fresh = np.ones(len(at), bool)
        fresh[1:] = ((piece[1:] != piece[:-1]) | (item[1:] != item[:-1])
                     | (band[1:] != band[:-1]) | (at[1:] != at[:-1]))
        piece, item, at, diagonal, band = piece[fresh], item[fresh], at[fresh], diagonal[fresh], band[fresh]
        group = np.cumsum(np.concatenate(([0], (piece[1:] != piece[:-1]) | (item[1:] != item[:-1])
                                          | (band[1:] != band[:-1])))) if len(at) else np.empty(0, np.int64)
        begins = np.flatnonzero(np.diff(group, prepend=-1))
        ends = np.append(begins[1:], len(at))
        for g in np.flatnonzero(ends - begins >= self.bound[item[begins]]):
            first, last = begins[g], ends[g]
            k = int(item[first])
            row, offset, _ = pieces[piece[first]]
            begin, end = int(starts[piece[first]]), int(starts[piece[first] + 1]) - 1
            windows = self._windows(k, int(band[first]), at[first:last], diagonal[first:last], body, begin, end)
            if windows:
                found.setdefault((row, k), []).extend(
                    (a, d - begin + offset, body[lo:hi], lo - begin + offset) for a, d, lo, hi in windows)
        return found

    def _windows(self, k: int, band: int, at: np.ndarray, diagonal: np.ndarray, body: bytes,
                 begin: int, end: int) -> list[tuple[int, int, int, int]]:
        """Verified windows (start in the item, diagonal, slice of the body) of one band,
        as many as have the union of all."""
        text, region, edits = self.items[k][1], int(self.region[k]), int(self.edits[k])
        starts = np.arange(len(text) - region + 1)
        left, right = np.searchsorted(at, starts), np.searchsorted(at, starts + region - Q, side="right")
        near = right - left >= self.bound[k]
        step, out = edits + 1, []

        def verified(a: int) -> bool:
            if not near[a]:
                return False
            lo = max(begin, a + band * step - edits)
            hi = min(end, a + region + (band + 2) * step - 1 + edits)
            if aligned_edits(text[a:a + region], body[lo:hi], edits) > edits:
                return False
            out.append((a, int(np.median(diagonal[left[a]:right[a]])), lo, hi))
            return True

        a, most = 0, len(text) - region
        while a <= most:
            if not verified(a):
                a += 1
                continue
            # On to the furthest window that joins what is covered.
            while (after := next((b for b in range(min(a + region, most), a, -1) if verified(b)), None)) is not None:
                a = after
            a += region + 1
        return out


def _spans(windows: list, region: int, slack: int) -> list[list]:
    """Windows of one text joined to stretches: those that touch in the item and lie on
    diagonals at most ``slack`` apart."""
    spans, open_ = [], []
    for w in sorted(windows, key=lambda w: (w[0] + w[1], w[0])):
        a, d = w[:2]
        open_ = [s for s in open_ if s[-1][0] + s[-1][1] + region + slack >= a + d]
        mine = [s for s in open_ if any(abs(x[1] - d) <= slack and abs(x[0] - a) <= region
                                        for x in reversed(s[-8:]))]
        if not mine:
            mine = [[]]
            spans.append(mine[0])
            open_.append(mine[0])
        for other in mine[1:]:
            mine[0].extend(other)
            spans = [s for s in spans if s is not other]
            open_ = [s for s in open_ if s is not other]
        mine[0].append(w)
    return spans


def _joined(parts: list[tuple[int, bytes]]) -> bytes:
    """The text of overlapping slices (place, bytes)."""
    parts = sorted(parts)
    out, at = parts[0][1], parts[0][0]
    for place, piece in parts[1:]:
        out += piece[max(0, at + len(out) - place):]
    return out


def _chunks(texts: list[bytes]):
    chunk, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - OVERLAP), CHUNK - OVERLAP):
            piece = text[at:at + CHUNK]
            if chunk and size + len(piece) > CHUNK:
                yield chunk
                chunk, size = [], 0
            chunk.append((row, at, piece))
            size += len(piece) + 1
    if chunk:
        yield chunk


def search(texts: list[bytes], index: Index) -> list[tuple[int, int, int, int, int]]:
    """(row, item_id, regions, characters of the item covered, least edits).

    A region is a whole stretch of the text in which windows of the item were found; its
    edits are those of all of the item that it covers.
    """
    found: dict[tuple[int, int], list] = {}
    for chunk in _chunks([normalised(t) for t in texts]):
        for key, windows in index.leaks(chunk).items():
            found.setdefault(key, []).extend(windows)
    out = []
    for (row, k), windows in sorted(found.items()):
        (item, text), region = index.items[k], int(index.region[k])
        spans = _spans(windows, region, 2 * int(index.edits[k]) + 1)
        ends = [(min(w[0] for w in s), max(w[0] for w in s) + region) for s in spans]
        covered, end = 0, 0
        for a, b in sorted(ends):
            covered += max(0, b - max(a, end))
            end = max(end, b)
        edits = None
        for (a, b), s in zip(ends, spans):
            most = b - a if edits is None else edits
            cost = aligned_edits(text[a:b], _joined([(w[3], w[2]) for w in s]), most)
            edits = cost if edits is None else min(edits, cost)
            if not edits:
                break
        out.append((row, item, len(spans), covered, edits))
    return out


def _slices(benchmark: DataFrame, item_id: str, text: str, max_bytes: int):
    rows = benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-total // max_bytes))
    for k in range(passes):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).collect()
        items = [(r["item_id"], normalised((r["text"] or "").encode())) for r in part]
        yield Index(sorted((i, t) for i, t in items if i is not None and len(t) >= LEAST_ITEM)), passes > 1


def leaks(documents: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text", max_bytes: int = MAX_BYTES) -> DataFrame:
    """``doc_id, item_id, regions, chars, edits`` for every item found in a document."""
    source = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    out = None
    for index, several in _slices(benchmark, item_id, item_text, max_bytes):
        found = source.mapInArrow(_finder(index), LEAKS.replace("row", "doc_id"))
        found = keep(found, "leaks") if several else found
        out = found if out is None else out.unionByName(found)
    return out


def _finder(index: Index):
    def find(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = search(list(utf8(batch.column(1))), index)
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[r] for r in columns[0]], pa.int64())]
                + [pa.array(list(c), pa.int64()) for c in columns[1:]],
                ["doc_id", "item_id", "regions", "chars", "edits"])
    return lean(find)


def drop_leaks(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """The input without the documents that hold a benchmark item."""
    gone = keep(leaks(documents, benchmark, doc_id=doc_id, text=text)
                .select(F.col("doc_id").alias(doc_id)).distinct(), "leaking")
    small = gone.count() <= MAX_BROADCAST
    return documents.join(F.broadcast(gone) if small else gone, doc_id, "left_anti").select(
        *[F.col(f"`{c}`") for c in documents.columns])
