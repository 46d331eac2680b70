"""Removal of long byte strings that already stand in an earlier document.

Every start of a ``LENGTH``-byte string belongs to the smallest-hashed gram inside
it (its anchor), so equal strings have equal anchors wherever they stand. Only
stretches around anchors that several documents share can repeat:

1. documents are dealt into batches; each batch lists its anchors, by part of the
   hash range;
2. each part finds the anchors of several documents and marks them for the batches;
3. each batch sends the distinct stretches around them, with the smallest doc_id;
4. each part cuts its stretches into shards of whole anchors, sorts the suffixes of each
   shard (Larsson-Sadakane refinement), finds equal strings from common prefixes of
   neighbours (Kasai) and merges the shards of an anchor that fills several by binary
   search; every start learns whether a smaller doc_id than the batch's has its string;
5. each batch removes what stands in a smaller document, its own or another batch's.

Batches and parts both grow with the square root of the input, so a task's memory
does not grow in proportion, and a block between a batch and a part stays for at least
``BLOCK_BYTES`` of text. Blocks are columns of numbers in one order on both sides, so
what is told of an anchor is a mark and what is told of a start is a bit. Parts are dealt
by bits of the anchors' hashes that are spread evenly. An anchor whose stretches would fill
more than a shard, by the batches it stands in, is split: its strings are dealt by their own
content. A batch makes strings of it once for each distinct stretch, not each occurrence.

Defined cases: a null text is empty; a text shorter than ``LENGTH`` bytes keeps all;
rows of one doc_id never remove from each other; a null doc_id counts as the
largest; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkframe.llm.words import odd_numbers, release, utf8

LENGTH = 50
GRAM = 24
CHUNK_BITS = 17
BATCH_BYTES = 4_000_000
# So many parts are as many as batches; beyond, four batches make a part.
PARTS = 64
# A block between a batch and a part stands for so much text at least.
BLOCK_BYTES = 1_000
KEY_BITS = 31
# Suffixes of so many bytes are sorted at once; of one anchor, four times as many.
SHARD_BYTES = 1 << 16
# An anchor in no more batches than this is never split by content.
HOT_BATCHES = 256
NO_ID = 2**63 - 1

_B = odd_numbers(6, 50)
_BYTES = np.arange(1, 257, dtype=np.uint64) * _B[0]


# --- anchors -----------------------------------------------------------------

def _gram_hashes(a: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes at each place."""
    h = _BYTES[a]
    for k, s in enumerate((1, 2, 4)):
        longer = h[:-s] * _B[1 + k]
        longer += h[s:]
        h = longer
    longer = h[:-8] * _B[4]
    longer += h[8:]
    longer = longer[:-8] * _B[4]
    longer += h[16:]
    h = longer
    h ^= h >> np.uint64(32)
    h *= _B[5]
    h ^= h >> np.uint64(29)
    return h


def _window_least(v: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        s = min(have, width - have)
        v = np.minimum(v[:-s], v[s:])
        have += s
    return v


def runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Runs of starts with one anchor: text number, first start, starts, anchor hash, and
    a hash of the stretch.

    The texts are hashed in a row, a chunk at a time, with the overlap that every start
    needs; a run ends with its chunk.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    a = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum(sizes) - sizes
    until = begin + np.maximum(sizes - LENGTH + 1, 0)
    breaks = np.sort(np.append(begin, until))
    out, low, step = [], np.uint64((1 << CHUNK_BITS) - 1), (1 << CHUNK_BITS) - LENGTH + 1
    for at in range(0, len(a) - LENGTH + 1, step):
        h = _gram_hashes(a[at:at + step + LENGTH - 1])
        least = _window_least((h & ~low) | np.arange(len(h), dtype=np.uint64), LENGTH - GRAM + 1)
        turns = np.ones(len(least), bool)
        np.not_equal(least[1:], least[:-1], out=turns[1:])
        inside = slice(*np.searchsorted(breaks, (at, at + len(least))))
        turns[breaks[inside] - at] = True
        first = np.flatnonzero(turns)
        count = np.diff(np.append(first, len(least)))
        text = np.searchsorted(begin, at + first, "right") - 1
        valid = at + first < until[text]
        first, count, text = first[valid], count[valid], text[valid]
        # Grams that cover the stretch between them.
        last = first + count + (LENGTH - 1 - GRAM)
        prints = h[first] * _B[1] + h[first + GRAM] * _B[2] + h[np.minimum(first + 2 * GRAM, last)] * _B[3] + h[last]
        out.append((text, at + first - begin[text], count, h[(least[first] & low).astype(np.int64)], prints))
    if not out:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    return tuple(np.concatenate(x) for x in zip(*out))


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Dealt by middle bits: an anchor's hash is the smallest of many, so its upper bits are small."""
    middle = keys >> np.uint64(20) & np.uint64(2**32 - 1)
    return (middle * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _codes(keys: np.ndarray, parts: int) -> np.ndarray:
    """What identifies an anchor: its part and the lower ``KEY_BITS`` bits of its hash."""
    return ((_part(keys, parts).astype(np.uint64) << np.uint64(KEY_BITS))
            | (keys & np.uint64((1 << KEY_BITS) - 1)))


def _ids(column) -> np.ndarray:
    return column.combine_chunks().fill_null(NO_ID).to_numpy()


def _rows(table: pa.Table) -> tuple[pa.Table, np.ndarray, list[bytes]]:
    """The documents of a batch in an order that every step finds again."""
    table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return table, _ids(table.column("doc_id")), list(utf8(table.column("text").combine_chunks()))


# --- blocks ------------------------------------------------------------------

def _flat(column, kind) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in a column of blocks, in a row, and how many each block holds."""
    sizes = pc.binary_length(column).to_numpy() // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(c for c in column.to_pylist() if c), kind), sizes


def _open(column) -> tuple[bytes, np.ndarray]:
    """What compressed blocks hold, in a row, and the bytes of each."""
    press = zstandard.ZstdDecompressor()
    blocks = [press.decompress(c) for c in column.to_pylist()]
    return b"".join(blocks), np.array([len(b) for b in blocks], np.int64)


def _blocks(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Numbers in a row as blocks of so many each."""
    ends = np.concatenate(([0], np.cumsum(sizes))) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [
        None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _pressed(data: bytes, sizes: np.ndarray) -> pa.Array:
    ends = np.cumsum(sizes)
    press = zstandard.ZstdCompressor(level=1)
    return pa.array([press.compress(data[a:b]) for a, b in zip((ends - sizes).tolist(), ends.tolist())],
                    pa.binary())


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over consecutive groups of the given sizes, which may be 0."""
    ends = np.cumsum(sizes)
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[ends] - total[ends - sizes]


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``begin, begin + 1, ...`` of each range, in a row."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + sizes, sizes)


def _numbered(contents: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The number of each content, by first appearance, and the distinct contents."""
    distinct = list(dict.fromkeys(contents))
    number = dict(zip(distinct, range(len(distinct))))
    return np.fromiter(map(number.__getitem__, contents), np.int64, len(contents)), distinct


def _sorted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of the values, equal ones as they stand, and the sorted values.

    Values with room for it are sorted as one number with their place.
    """
    bits = np.uint64(max(1, len(values)).bit_length())
    if len(values) and int(values.max()) >> (64 - int(bits)):
        order = np.argsort(values, kind="stable")
        return order, values[order]
    packed = values.astype(np.uint64) << bits
    packed |= np.arange(len(values), dtype=np.uint64)
    packed.sort()
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    packed >>= bits
    return order, packed


def _classes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values, which of them each value is, and how often each stands."""
    order, ordered = _sorted(values)
    turns = np.ones(len(values), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=turns[1:])
    which = np.empty(len(values), np.int64)
    which[order] = np.cumsum(turns) - 1
    first = np.flatnonzero(turns)
    return ordered[first], which, np.diff(np.append(first, len(values)))


# --- suffix arrays -----------------------------------------------------------

def _words(text: np.ndarray, n: int) -> np.ndarray:
    """The eight bytes from each of ``n`` places on as a number; behind the end are zeros."""
    padded = np.concatenate((text, np.zeros(n + 7 - len(text), np.uint8)))
    bytes_ = np.lib.stride_tricks.sliding_window_view(padded, 8)
    return np.ascontiguousarray(bytes_).view(">u8").ravel().astype(np.uint64)


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` bytes at least, and their ranks.

    Larsson-Sadakane: suffixes are sorted by eight bytes, then groups of equal ones,
    and only those, by the rank of the suffix as many bytes further on, doubling.
    """
    n = len(text)
    words = _words(text, n)
    order = np.argsort(words)
    w = words[order]
    head = np.concatenate(([True], w[1:] != w[:-1]))
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = np.maximum.accumulate(np.where(head, np.arange(n), 0)), -1
    h, bits = 8, n.bit_length()
    while h < depth:
        alone = head & np.append(head[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        who = order[slots]
        # Group and rank behind, both below n + 1, in one number, and the place where it fits.
        both = rank[who]
        both <<= bits
        both |= rank[np.minimum(who + h, n)] + 1
        if 3 * bits < 64:
            both <<= bits
            both |= who
            both.sort()
            who = both & ((1 << bits) - 1)
            both >>= bits
        else:
            turn = np.argsort(both, kind="stable")
            who, both = who[turn], both[turn]
        order[slots] = who
        new = np.ones(len(who), bool)
        np.not_equal(both[1:], both[:-1], out=new[1:])
        head[slots] = new
        rank[who] = np.maximum.accumulate(np.where(new, slots, 0))
        h *= 2
    return order, rank[:n]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the prefix each suffix shares with the one before it in ``order``.

    Kasai's rule in permuted form: where a suffix and its predecessor both continue
    those of the place before, their common prefix is one shorter. Only the other
    places are compared, eight bytes at a time, up to ``depth``.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    follows = np.zeros(n, bool)
    follows[1:] = ((before[1:] == before[:-1] + 1) & (before[:-1] >= 0)
                   & (text[:-1] == text[np.maximum(before[:-1], 0)]))
    fresh = np.flatnonzero(~follows)
    length = np.zeros(n, np.int64)
    words = _words(text, n + 4 * depth + 8)
    live = fresh[before[fresh] >= 0]
    # A continued place may need more than ``depth`` of its first.
    for at in range(0, 4 * depth, 8):
        odd = words[live + at] ^ words[before[live] + at]
        ends = odd != 0
        length[live] += 8
        odd = odd[ends]
        for k in range(8):
            length[live[ends]] -= odd >= np.uint64(1 << 8 * k)
        live = live[~ends]
        if not len(live):
            break
    length[fresh] = np.minimum(length[fresh], n - np.maximum(fresh, before[fresh]))
    base = np.maximum.accumulate(np.where(~follows, np.arange(n), 0))
    permuted = np.maximum(length[base] - (np.arange(n) - base), 0)
    # A run of continued places longer than what was compared is compared again.
    short = np.flatnonzero(follows & (permuted < depth) & (length[base] >= 4 * depth))
    padded = np.concatenate((text, np.zeros(depth, np.uint8))) if len(short) else text
    for k in range(0, len(short), 8192):
        i = short[k:k + 8192]
        j = before[i]
        equal = padded[i[:, None] + np.arange(depth)] == padded[j[:, None] + np.arange(depth)]
        permuted[i] = np.where(equal.all(axis=1), depth, equal.argmin(axis=1))
    return permuted[order]


def _shard_classes(stretches: list[bytes], docs: np.ndarray, length: int):
    """A shard's text, a place of each distinct string in their order, their smallest
    doc_id, and each start's string."""
    text = np.frombuffer(b"\0".join(stretches), np.uint8)
    sizes = np.array([len(s) for s in stretches])
    begin = np.cumsum(sizes + 1) - sizes - 1
    starts = sizes - length + 1
    number = np.repeat(np.arange(len(stretches)), starts)
    place = begin[number] + np.arange(len(number)) - np.repeat(np.cumsum(starts) - starts, starts)
    order, _ = suffix_array(text, length)
    prefix = common_prefixes(text, order, length)
    group = np.empty(len(text), np.int64)
    group[order] = np.cumsum(prefix < length)
    group = group[place]
    used = np.zeros(len(text) + 1, bool)
    used[group] = True
    which = (np.cumsum(used) - 1)[group]  # numbered as sorted
    least = np.full(which.max() + 1, NO_ID)
    np.minimum.at(least, which, docs[number])
    sample = np.empty(len(least), np.int64)
    sample[which] = place
    return text, sample, least, which


def _strings(text: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    view = np.lib.stride_tricks.sliding_window_view(text, length)[places]
    return np.ascontiguousarray(view).view(f"S{length}").ravel()


def least_documents(stretches: list[bytes], docs: np.ndarray, length: int = LENGTH,
                    shard_bytes: int = 4 * SHARD_BYTES) -> list[np.ndarray]:
    """For each start of each distinct stretch, the smallest doc_id with its string.

    The sorted strings of all shards are merged one shard at a time, each found in what
    is there by binary search or inserted.
    """
    starts = np.array([len(s) - length + 1 for s in stretches], np.int64)
    told = np.concatenate([np.empty(0, np.int64), *_least_of_starts(stretches, docs, length, shard_bytes)])
    return np.split(told, np.cumsum(starts)[:-1])


def _least_of_starts(stretches: list[bytes], docs: np.ndarray, length: int, shard_bytes: int) -> list[np.ndarray]:
    cuts, size = [0], 0
    for k, s in enumerate(stretches):
        if size and size + len(s) > shard_bytes:
            cuts.append(k)
            size = 0
        size += len(s) + 1
    cuts.append(len(stretches))
    shards = [_shard_classes(stretches[a:b], docs[a:b], length)
              for a, b in zip(cuts[:-1], cuts[1:]) if b > a]
    if len(shards) == 1:
        return [least[which] for _, _, least, which in shards]
    known, earliest = np.empty(0, f"S{length}"), np.empty(0, np.int64)
    for text, sample, least, _ in shards:
        mine = _strings(text, sample, length)
        at = np.searchsorted(known, mine)
        there = np.zeros(len(mine), bool)
        inside = at < len(known)
        there[inside] = known[at[inside]] == mine[inside]
        earliest[at[there]] = np.minimum(earliest[at[there]], least[there])
        known = np.insert(known, at[~there], mine[~there])
        earliest = np.insert(earliest, at[~there], least[~there])
    return [earliest[np.searchsorted(known, _strings(text, sample, length))][which]
            for text, sample, _, which in shards]


# --- the five steps ----------------------------------------------------------

ANCHORS = "part bigint, batch bigint, keys binary"
MARKS = "part bigint, batch bigint, marks binary"
STRETCHES = "part bigint, batch bigint, marks binary, keys binary, sizes binary, docs binary, body binary"
ANSWERS = "part bigint, batch bigint, marks binary, told binary, mixed binary"
SPANS = "doc_id bigint, n_bytes bigint, spans array<struct<start bigint, length bigint>>, kept binary"
KINDS = {"bigint": pa.int64(), "binary": pa.binary()}


def _frame(columns: str, *values) -> pa.Table:
    fields = [c.split() for c in columns.split(", ")]
    values = values or [[]] * len(fields)
    return pa.table({name: pa.array(v, KINDS[kind]) for (name, kind), v in zip(fields, values)})


def _anchors(parts: int):
    def work(table: pa.Table) -> pa.Table:
        _, ids, texts = _rows(table)
        text, _, _, keys, _ = runs(texts)
        if not len(keys):
            return _frame(ANCHORS)
        codes = _codes(keys, parts)
        turn, codes = _sorted(codes)
        doc = ids[text[turn]]
        first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
        codes = codes[first]
        part, sizes = np.unique(codes >> np.uint64(KEY_BITS), return_counts=True)
        told = (codes << np.uint64(1)).astype(np.uint32) | several.astype(np.uint32)
        batch = np.full(len(part), table.column("batch")[0].as_py())
        return _frame(ANCHORS, part.astype(np.int64), batch, _blocks(told, sizes))
    return work


def _shared(hot_batches: float):
    def work(table: pa.Table) -> pa.Table:
        told, sizes = _flat(table.column("keys"), np.uint32)
        _, which, counts = _classes(told >> np.uint32(1))
        several = np.bincount(which, told & np.uint32(1), len(counts)) > 0
        mark = np.where(counts > hot_batches, 2, 1) * ((counts > 1) | several)
        return _frame(MARKS, table.column("part").combine_chunks(), table.column("batch").combine_chunks(),
                      _pressed(mark[which].astype(np.uint8).tobytes(), sizes))
    return work


def _alike(joined: bytes, at: np.ndarray, size: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each slice by its content, and one slice of each number.

    Slices of one hash are compared; should two of them differ, contents decide for all.
    """
    number = _classes(prints >> np.uint64(len(prints).bit_length()))[1]
    sample = np.empty(number.max(initial=-1) + 1, np.int64)
    sample[number] = np.arange(len(number))
    one = sample[number]
    more = np.flatnonzero(one != np.arange(len(one)))
    one = one[more]
    if not all(joined[a:b] == joined[c:d] for a, b, c, d in zip(
            at[more].tolist(), (at + size)[more].tolist(), at[one].tolist(), (at + size)[one].tolist())):
        number, distinct = _numbered([joined[a:b] for a, b in zip(at.tolist(), (at + size).tolist())])
        sample = np.empty(len(distinct), np.int64)
        sample[number] = np.arange(len(number))
    return number, sample


def _stretches(texts: list[bytes], marks: np.ndarray, parts: int):
    """Occurrences of stretches around marked anchors, as (text, start, starts, number of
    stretch), and the distinct stretches by part: part, lower bits of the hash, where they
    stand in the joined texts, bytes."""
    text, start, count, keys, prints = runs(texts)
    codes = _codes(keys, parts)
    mark = marks[_classes(codes)[1]]
    take = np.flatnonzero(mark)
    text, start, count, codes, mark, prints = (x[take] for x in (text, start, count, codes, mark, prints))
    sizes = np.array([len(t) for t in texts], np.int64)
    at = (np.cumsum(sizes) - sizes)[text] + start
    joined = b"".join(texts)
    number, sample = _alike(joined, at, count + (LENGTH - 1), prints)
    part = (codes[sample] >> np.uint64(KEY_BITS)).astype(np.int64)
    low = codes[sample] & np.uint64((1 << KEY_BITS) - 1)
    where, starts = at[sample], count[sample]
    hot = mark == 2
    if hot.any():
        # A stretch of a hot anchor, once for all its occurrences, becomes its strings.
        split, stays = np.flatnonzero(mark[sample] == 2), np.flatnonzero(mark[sample] == 1)
        single = _ranges(where[split], starts[split])
        which, strings = _numbered([joined[a:a + LENGTH] for a in single.tolist()])
        one = np.empty(len(strings), np.int64)
        one[which] = np.arange(len(which))
        place = np.empty(len(sample), np.int64)
        place[stays], place[split] = np.arange(len(stays)), np.cumsum(starts[split]) - starts[split]
        apart = _ranges(place[number[hot]], count[hot])
        number = np.append(place[number[~hot]], len(stays) + which[apart])
        text = np.append(text[~hot], np.repeat(text[hot], count[hot]))
        start = np.append(start[~hot], _ranges(start[hot], count[hot]))
        count = np.append(count[~hot], np.ones(len(apart), np.int64))
        low = np.append(low[stays], np.repeat(low[split], starts[split])[one])
        part = np.append(part[stays], _part(
            np.array([xxhash.xxh3_64_intdigest(s) for s in strings], np.uint64), parts))
        where, starts = np.append(where[stays], single[one]), np.append(starts[stays], np.ones(len(one), np.int64))
    # By part, then by anchor, so that like contents stand together.
    turn, _ = _sorted(part.astype(np.uint64) << np.uint64(KEY_BITS) | low)
    place = np.empty(len(turn), np.int64)
    place[turn] = np.arange(len(turn))
    return (text, start, count, place[number]), (
        part[turn], low[turn].astype(np.uint32), where[turn], starts[turn] + (LENGTH - 1))


def _least(number: np.ndarray, docs: np.ndarray, distinct: int) -> np.ndarray:
    least = np.full(distinct, NO_ID)
    np.minimum.at(least, number, docs)
    return least


def _send(parts: int):
    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _frame(STRETCHES)
        _, ids, texts = _rows(left)
        right = right.sort_by("part")
        marks, _ = _open(right.column("marks"))
        (text, _, _, number), (part, low, where, sizes) = _stretches(texts, np.frombuffer(marks, np.uint8), parts)
        least = _least(number, ids[text], len(sizes))
        joined = b"".join(texts)
        body = b"".join([joined[a:b] for a, b in zip(where.tolist(), (where + sizes).tolist())])
        # Every block of marks goes along, and comes back with the answers.
        mine = dict(zip(right.column("part").to_pylist(), right.column("marks").to_pylist()))
        to = np.union1d(part, np.array(list(mine), np.int64))
        counts = np.bincount(np.searchsorted(to, part), minlength=len(to))
        ends = np.cumsum(counts)
        # Bytes of one significance stand together, as most are alike.
        docs = b"".join(least[a:b].view(np.uint8).reshape(-1, 8).T.tobytes()
                        for a, b in zip((ends - counts).tolist(), ends.tolist()))
        batch = np.full(len(to), left.column("batch")[0].as_py())
        return _frame(STRETCHES, to, batch, [mine.get(p) for p in to.tolist()], _blocks(low, counts),
                      _blocks(sizes.astype(np.uint8), counts), _pressed(docs, 8 * counts),
                      _pressed(body, _sums(sizes, counts)))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = send(left, right)
        release(collect=False)
        return out
    return work


def earlier_starts(keys: np.ndarray, contents: list[bytes], docs: np.ndarray,
                   length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """For each stretch, whether a smaller doc_id than its own has the strings of none (0),
    all (1) or some (2) of its starts, and a bit for each start of the last kind, in a row.

    Equal strings stand in stretches of one key, so shards of whole keys share none; only
    the shards of a key that fills several are merged.
    """
    number, distinct = _numbered(contents)
    least = _least(number, docs, len(distinct))
    key = np.empty(len(distinct), np.uint32)
    key[number] = keys
    _, which, counts = _classes(key)
    starts = np.fromiter(map(len, distinct), np.int64, len(distinct)) - (length - 1)
    # Distinct contents of one start each are distinct strings.
    longer = np.bincount(which, starts > 1, len(counts)) > 0
    unclear = np.flatnonzero(((counts > 1) & longer)[which])
    unclear = unclear[_sorted(which[unclear])[0]]
    starts = starts[unclear]
    begin = np.cumsum(starts) - starts
    first = np.flatnonzero(np.diff(which[unclear], prepend=-1))
    bounds = np.append(first, len(unclear))
    reach = np.concatenate(([0], np.cumsum(starts + length)))[bounds]
    cuts = [0]
    while cuts[-1] < len(first):
        most = np.searchsorted(reach, reach[cuts[-1]] + shard_bytes, "right") - 1
        cuts.append(max(int(most), cuts[-1] + 1))
    earliest = [np.empty(0, np.int64)]
    for a, b in zip(bounds[cuts[:-1]].tolist(), bounds[cuts[1:]].tolist()):
        earliest += _least_of_starts(
            [distinct[k] for k in unclear[a:b].tolist()], least[unclear[a:b]], length, 4 * shard_bytes)
    earliest = np.concatenate(earliest)
    told, mixed = (least[number] < docs).astype(np.uint8), [np.empty(0, np.uint8)]
    place = np.full(len(distinct), -1)
    place[unclear] = np.arange(len(unclear))
    asked = np.flatnonzero(place[number] >= 0)
    for k in range(0, len(asked), 1 << 14):
        some = asked[k:k + (1 << 14)]
        at = place[number[some]]
        bits = earliest[_ranges(begin[at], starts[at])] < np.repeat(docs[some], starts[at])
        n = _sums(bits, starts[at])
        told[some] = np.where(n == 0, 0, np.where(n == starts[at], 1, 2))
        mixed.append(bits[np.repeat(told[some] == 2, starts[at])].astype(np.uint8))
    return told, np.concatenate(mixed)


def _answered(table: pa.Table) -> pa.Table:
    keys, counts = _flat(table.column("keys"), np.uint32)
    sizes, _ = _flat(table.column("sizes"), np.uint8)
    planes, planes_sizes = _open(table.column("docs"))
    docs = np.frombuffer(b"".join(
        np.frombuffer(planes[a:b], np.uint8).reshape(8, -1).T.tobytes() for a, b in zip(
            (np.cumsum(planes_sizes) - planes_sizes).tolist(), np.cumsum(planes_sizes).tolist())), np.int64)
    body, _ = _open(table.column("body"))
    ends = np.cumsum(sizes, dtype=np.int64)
    contents = [body[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]
    told, mixed = earlier_starts(keys, contents, docs)
    bits = (sizes.astype(np.int64) - LENGTH + 1) * (told == 2)
    return _frame(ANSWERS, *(table.column(c).combine_chunks() for c in ("part", "batch", "marks")),
                  _blocks(told, counts), _blocks(mixed, _sums(bits, counts)))


def _answer(table: pa.Table) -> pa.Table:
    out = _answered(table)
    release(collect=False)
    return out


def _cuts(texts: list[bytes], ids: np.ndarray, right: pa.Table, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of removed strings, in the texts joined with one byte between."""
    sizes = np.array([len(t) for t in texts], np.int64)
    offset = np.cumsum(sizes + 1) - sizes - 1
    right = right.sort_by("part")
    marks, _ = _open(right.filter(pc.is_valid(right.column("marks"))).column("marks"))
    (text, start, count, number), (_, _, _, length) = _stretches(texts, np.frombuffer(marks, np.uint8), parts)
    told, _ = _flat(right.column("told"), np.uint8)
    mixed, _ = _flat(right.column("mixed"), np.uint8)
    least = _least(number, ids[text], len(length))
    told_here = told[number]
    whole = (told_here == 1) | (least[number] < ids[text])
    begin = offset[text] + start
    starts = (length - LENGTH + 1) * (told == 2)
    some = np.flatnonzero((told_here == 2) & ~whole)
    one = _ranges((np.cumsum(starts) - starts)[number[some]], count[some])
    single = _ranges(begin[some], count[some])[mixed[one] == 1]
    return (np.append(begin[whole], single),
            np.append((begin + count + (LENGTH - 1))[whole], single + LENGTH))


def _remove(parts: int):
    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        left, ids, texts = _rows(left)
        sizes = np.array([len(t) for t in texts], np.int64)
        joined = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
        cover = np.zeros(len(joined) + 1, np.int32)
        if right.num_rows:
            begin, end = _cuts(texts, ids, right, parts)
            np.add.at(cover, begin, 1)
            np.add.at(cover, end, -1)
            np.cumsum(cover, out=cover)
        gone = cover > 0
        turns = np.flatnonzero(gone[1:] != gone[:-1]) + 1
        if gone[0]:
            turns = np.append(0, turns)
        begin, length = turns[::2], turns[1::2] - turns[::2]
        offset = np.cumsum(sizes + 1) - sizes - 1
        stays = ~gone[:-1]
        stays[offset + sizes] = False
        text = np.searchsorted(offset, begin, "right") - 1
        spans = pa.StructArray.from_arrays([pa.array(begin - offset[text]), pa.array(length)], ["start", "length"])
        until = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(texts))))).astype(np.int32)
        return pa.table({
            "doc_id": left.column("doc_id"), "n_bytes": pa.array(sizes),
            "spans": pa.ListArray.from_arrays(pa.array(until), spans),
            "kept": _blocks(joined[stays], sizes - _sums(length, np.diff(until)))})

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = remove(left, right)
        release(collect=False)
        return out
    return work


def layout(total: int, batch_bytes: int = BATCH_BYTES) -> tuple[int, int]:
    """Batches and parts for so many bytes of text. Only what is shared goes to parts, so
    there are fewer of them."""
    batches = max(1, math.ceil(total / max(batch_bytes, math.sqrt(total * BLOCK_BYTES))))
    return batches, min(batches, max(PARTS, batches // 4))


def hot_above(batches: int) -> float:
    """In how many of so many batches an anchor stands whose documents, dealt at random,
    have stretches that fill a shard."""
    return max(HOT_BATCHES, -batches * math.expm1(-4 * SHARD_BYTES / (1.5 * LENGTH) / batches))


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   batch_bytes: int = BATCH_BYTES, hot_batches: int | None = None) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for every row: removed byte spans and what is left.

    The texts are shuffled once, into their batches; the three steps that read them
    share that exchange, as they stand in one plan. An anchor in more than
    ``hot_batches`` batches (``hot_above`` them by default) is split by content.
    """
    source = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches, parts = layout(total, batch_bytes)
    base = source.select(F.pmod(F.xxhash64("doc_id"), F.lit(batches)).alias("batch"), "doc_id", "text")
    anchors = base.groupBy("batch").applyInArrow(_anchors(parts), ANCHORS)
    hot = hot_above(batches) if hot_batches is None else hot_batches
    shared = anchors.groupBy("part").applyInArrow(_shared(hot), MARKS)
    sent = base.groupBy("batch").cogroup(shared.groupBy("batch")).applyInArrow(_send(parts), STRETCHES)
    answers = sent.groupBy("part").applyInArrow(_answer, ANSWERS)
    return base.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_remove(parts), SPANS)
