import random

import numpy as np
import pytest

from rinkframe.llm import suffixes


def by_hand(rows):
    """Removed byte spans of every row."""
    earliest = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            g = b[p:p + 50]
            i_ = 2**63 - 1 if i is None else i
            earliest[g] = min(earliest.get(g, i_), i_)
    out = []
    for i, t in rows:
        b, cut = (t or "").encode(), set()
        for p in range(len(b) - 49):
            if earliest[b[p:p + 50]] < (2**63 - 1 if i is None else i):
                cut |= set(range(p, p + 50))
        out.append(bytes(x for k, x in enumerate(b) if k not in cut))
    return out


def corpus(seed):
    rng = random.Random(seed)
    letters = "ab " if seed % 2 else "abcdefghijklmnopqrstuvwxyz é\x00"
    passages = ["".join(rng.choice(letters) for _ in range(rng.choice((40, 50, 60, 200)))) for _ in range(8)]
    rows = []
    for k in range(40):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice(letters) for _ in range(80))
                 for _ in range(rng.randint(0, 5))]
        rows.append((k, "".join(parts)))
    rows += [(90, None), (91, ""), (5, rows[5][1]), (None, rows[6][1]), (92, "x" * 4000), (93, "x" * 300), (1, rows[2][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, hot", [(1, 256), (2, 0), (3, 1)])
def test_kept_bytes_equal_brute_force(documents, seed, hot):
    rows = corpus(seed)
    out = suffixes.remove_repeats(documents(rows), batch_bytes=1200, hot_batches=hot).collect()
    want = sorted(zip([(i is None, i or 0) for i, _ in rows], by_hand(rows)))
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), bytes(r["kept"])) for r in out) == want
    for r in out:
        assert r["n_bytes"] - sum(s["length"] for s in r["spans"]) == len(r["kept"])


def test_texts_longer_than_a_chunk(documents, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK_BITS", 9)
    rows = corpus(4)
    out = suffixes.remove_repeats(documents(rows)).collect()
    want = sorted(zip([(i is None, i or 0) for i, _ in rows], by_hand(rows)))
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), bytes(r["kept"])) for r in out) == want
    assert suffixes.remove_repeats(documents([])).count() == 0


def test_suffix_array_and_prefixes():
    rng = random.Random(8)
    for text in (b"banana" * 40, bytes(rng.choice(b"ab") for _ in range(700)), b"a" * 900, b"abc"):
        t = np.frombuffer(text, np.uint8)
        order, _ = suffixes.suffix_array(t, 50)
        heads = [text[i:i + 50] for i in order]
        assert heads == sorted(heads)
        prefix = suffixes.common_prefixes(t, order, 50)
        for k in range(1, len(order)):
            a, b = heads[k - 1], heads[k]
            n = next((j for j in range(min(len(a), len(b))) if a[j] != b[j]), min(len(a), len(b)))
            assert min(prefix[k], 50) == n


def test_shards_are_merged():
    rng = random.Random(9)
    parts = [bytes(rng.choice(b"ab") for _ in range(60)) for _ in range(50)]
    stretches = sorted(set(parts + [p[5:] for p in parts] + [p[:55] for p in parts]))
    docs = np.array([rng.randrange(100) for _ in stretches])
    earliest = {}
    for s, d in zip(stretches, docs):
        for p in range(len(s) - 49):
            earliest[s[p:p + 50]] = min(earliest.get(s[p:p + 50], 1000), d)
    got = suffixes.least_documents(stretches, docs, shard_bytes=500)
    for s, told in zip(stretches, got):
        assert told.tolist() == [earliest[s[p:p + 50]] for p in range(len(s) - 49)]


def test_blocks_between_batches_and_parts_stay_in_proportion():
    for total in (10**7, 10**8, 10**9, 10**11, 10**13):
        batches, parts = suffixes.layout(total)
        assert batches * parts <= max(1, total / 1000) * 1.1
    batches, parts = suffixes.layout(864_000_000)
    assert batches * parts < 50_000  # 186,624 with batches of 2 MB


def test_starts_learn_in_bits_over_shards_of_whole_keys():
    rng = random.Random(10)
    keys, contents = [], []
    for key in range(6):
        strings = ["".join(rng.choice("ab") for _ in range(70)).encode() for _ in range(3)]
        for s in strings:
            for _ in range(rng.randint(1, 4)):
                a = rng.randint(0, 15)
                contents.append(bytes([99 + key]) + s[a:] if rng.random() < 0.3 else s[a:])
                keys.append(key)
    docs = np.array([rng.randrange(20) for _ in keys])
    earliest = {}
    for key, s, d in zip(keys, contents, docs):
        for p in range(len(s) - 49):
            at = (key, s[p:p + 50])
            earliest[at] = min(earliest.get(at, 1000), d)
    for shard_bytes in (100, 400, 10**6):
        told, mixed = suffixes.earlier_starts(np.array(keys, np.uint32), contents, docs, shard_bytes=shard_bytes)
        mixed = mixed.tolist()
        for key, s, d, t in zip(keys, contents, docs, told):
            want = [int(earliest[key, s[p:p + 50]] < d) for p in range(len(s) - 49)]
            got, mixed = (mixed[:len(want)], mixed[len(want):]) if t == 2 else ([t] * len(want), mixed)
            assert got == want
        assert not mixed


def test_anchors_are_dealt_evenly_among_parts():
    rng = random.Random(11)
    texts = [bytes(rng.choice(b"abcdefgh ") for _ in range(5000)) for _ in range(40)]
    _, _, _, keys, *_ = suffixes.runs(texts)
    counts = np.bincount(suffixes._part(keys, 32), minlength=32)
    assert counts.max() < 1.3 * counts.mean()  # 12.9 times the mean by the upper bits of the hashes


def test_runs_cover_every_start_once(monkeypatch):
    rng = random.Random(12)
    texts = [bytes(rng.choice(b"ab") for _ in range(n)) for n in (0, 49, 50, 51, 700, 0, 3, 1500, 50, 0)]
    for bits in (7, 9, 17):
        monkeypatch.setattr(suffixes, "CHUNK_BITS", bits)
        text, start, count, keys, prints = suffixes.runs(texts)
        got = [(t, a + k) for t, a, n in zip(text.tolist(), start.tolist(), count.tolist()) for k in range(n)]
        assert got == [(t, a) for t, b in enumerate(texts) for a in range(len(b) - 49)]
        stretches = [texts[t][a:a + n + 49] for t, a, n in zip(text, start, count)]
        assert len(set(prints.tolist())) == len(set(stretches))
        anchor = dict()
        for s, key in zip(stretches, keys.tolist()):
            for k in range(len(s) - 49):
                assert anchor.setdefault(s[k:k + 50], key) == key


def test_slices_of_one_hash_are_told_apart_by_content():
    joined, at = b"abcabcabd", np.array([0, 3, 6, 1])
    for prints in (np.zeros(4, np.uint64), np.array([1, 1, 2, 3], np.uint64) << np.uint64(60)):
        number, sample = suffixes._alike(joined, at, np.array([3, 3, 3, 2]), prints)
        assert number[0] == number[1] and len(set(number.tolist())) == 3
        assert number[sample].tolist() == [0, 1, 2]


def test_stretches_of_hot_anchors_are_sent_as_their_strings():
    rng = random.Random(13)
    line = bytes(rng.choice(b"abcdef") for _ in range(90))
    texts = [line + bytes(rng.choice(b"ghij") for _ in range(40)) for _ in range(5)]
    anchors = len(set(suffixes._codes(suffixes.runs(texts)[3], 4).tolist()))
    joined, told = b"".join(texts), []
    for mark in (1, 2):
        (text, start, count, number), (_, _, where, sizes) = suffixes._stretches(
            texts, np.full(anchors, mark, np.uint8), 4)
        assert (sizes == 50).all() == (mark == 2)
        contents = [joined[a:a + n] for a, n in zip(where.tolist(), sizes.tolist())]
        assert len(set(contents)) == len(contents)
        for t, a, n, k in zip(text.tolist(), start.tolist(), count.tolist(), number.tolist()):
            assert texts[t][a:a + n + 49] == contents[k]
        told.append(sorted((t, a + k) for t, a, n in zip(text.tolist(), start.tolist(), count.tolist()) for k in range(n)))
    assert told[0] == told[1]


def test_hot_anchors_would_fill_a_shard():
    assert suffixes.hot_above(1) == suffixes.hot_above(200) == suffixes.HOT_BATCHES
    assert 1500 < suffixes.hot_above(2500) < 2500
    shard = 4 * suffixes.SHARD_BYTES / 75
    assert 0.9 * shard < suffixes.hot_above(10**6) < shard + 100


def test_a_batch_sends_to_fewer_parts():
    for total in (10**9, 10**10, 10**12):
        batches, parts = suffixes.layout(total)
        assert parts <= max(64, batches / 4)
