import itertools
import random
import re

import numpy as np

from rinkframe.llm import graph, hyperminhash


def sets(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def by_hand(rows):
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    s = [(i, sets(t)) for i, t in rows]
    for (a, x), (b, y) in itertools.combinations(s, 2):
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    return {i: root(i) for i, _ in rows}


def corpus():
    rng = random.Random(10)
    pool = [f"w{k}" for k in range(500)]
    base = [[rng.choice(pool) for _ in range(rng.choice((6, 30, 120)))] for _ in range(12)]
    rows = []
    for k in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.choice((0, 1, 1, 2, 4))):
            words[rng.randrange(len(words))] = rng.choice(pool)
        rows.append((1000 - k, " ".join(words)))
    passage = " ".join(rng.choice(pool) for _ in range(25))
    rows += [(2000 + k, passage + " " + " ".join(rng.choice(pool) for _ in range(30))) for k in range(40)]
    rows += [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one"), (7, "long " * 30000)]
    return rows


def test_components_equal_brute_force(documents, monkeypatch):
    monkeypatch.setattr(hyperminhash, "BLOCK", 8)
    monkeypatch.setattr(hyperminhash, "GROUP_ROWS", 100)
    rows = corpus()
    want = by_hand(rows)
    out = hyperminhash.near_duplicates(documents(rows + rows[:3])).collect()
    assert len(out) == len(rows) + 3
    size = {i: len(sets(t)) for i, t in rows}
    for r in out:
        assert r["component_id"] == want[r["doc_id"]] and r["n_shingles"] == size[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_dropping_keeps_columns_and_empty_tables(documents):
    rows = [(1, "a b c d e f"), (2, "A b c d e f"), (3, None), (4, ""), (None, "x y z")]
    out = hyperminhash.drop_near_duplicates(documents(rows))
    assert out.columns == documents([]).columns
    assert sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 1, 3, 4]
    assert hyperminhash.near_duplicates(documents([])).count() == 0


def test_registers_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for share in (0.2, 0.5, 0.75, 0.95):
        for _ in range(20):
            both = rng.integers(0, 2**64, int(400 * share), dtype=np.uint64)
            rest = rng.integers(0, 2**64, 400 - len(both), dtype=np.uint64)
            cut = len(rest) // 2
            a, b = np.append(both, rest[:cut]), np.append(both, rest[cut:])
            equal = (hyperminhash.registers(a) == hyperminhash.registers(b)).sum(keepdims=True)
            errors.append(hyperminhash.estimate(equal, np.array([len(a)]), np.array([len(b)]))[0] - share)
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.2


def test_long_chains_become_one_component(text_spark):
    edges = text_spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 90), (7, 7)], "a bigint, b bigint")
    labels = {r["id"]: r["label"] for r in graph.components(edges).collect()}
    assert {labels[k] for k in range(41)} == {0} and labels[100] == labels[90] == 90
