import random
from itertools import permutations

import numpy as np

from rinkframe.llm import audit

COLUMNS = [c.split()[0] for c in audit.AUDIT_TYPE.split(", ")]


def fails(rows, k):
    """Letters of the filters that row k fails, from the rule."""
    doc_id, text, _ = rows[k]
    text = text or ""
    words = text.encode().split()
    out = set()
    if len(words) < 200:
        out.add("A")
    if 100 * len(set(words)) < 50 * len(words):
        out.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text):
        out.add("C")
    if any(c in "#$%&*|" for c in text):
        out.add("D")
    if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows):
        out.add("E")
    return out


def brute(rows, good, toxic):
    out = []
    for part in {p or "" for _, _, p in rows}:
        docs = [(rows[k][0], fails(rows, k)) for k in range(len(rows)) if (rows[k][2] or "") == part]
        made = []
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                all_fail = sum(f in d[1] for d in docs)
                made.append([part, "".join(order), step, len(left), len(gone), all_fail - len(gone),
                             sum(d[1] == {f} for d in docs), sum(d[0] in good for d in gone),
                             sum(d[0] in toxic for d in gone)])
        share = {f: sum(m[4] for m in made if m[1][m[2] - 1] == f) for f in "ABCDE"}
        out += [tuple(m + [share[m[1][m[2] - 1]]]) for m in made]
    return sorted(out)


def corpus():
    rng = random.Random(3)
    base = ["Short", "", None, "many words of its own " + " ".join(f"w{k}" for k in range(300)),
            "the same " * 300, "CAPITALS " + " ".join(f"v{k}" for k in range(250)), "SHOUT # " * 200,
            "é" * 99 + "A" * 2, "x y|z", "tab\tand\vline\n" * 100, "a" * 300_000]
    rows = [(k, rng.choice(base), rng.choice(("s1", "s1", "s2", None, ""))) for k in range(150)]
    return rows + [(7, rows[7][1], "s2"), (7, rows[7][1], "s2"), (None, "Short", "s1"), (None, None, "s2")]


def test_audit_equals_every_order_run_by_hand(text_spark):
    rows = corpus()
    docs = text_spark.createDataFrame(
        [(*r, 1, 2, "m") for r in rows],
        "doc_id bigint, text string, source string, mask int, docs bigint, digest string").repartition(3)
    labels = text_spark.createDataFrame(
        [(k, int(k % 3 == 0), int(k % 5 == 0)) for k in range(120)] + [(3, 0, 1), (999, 1, 1), (None, 1, 1)],
        "doc_id bigint, quality int, toxic int")
    good = {k for k in range(120) if k % 3 == 0}
    toxic = {k for k in range(120) if k % 5 == 0} | {3}
    out = audit.audit(audit.failure_cells(docs, labels))
    assert out.columns == COLUMNS
    assert sorted(tuple(r) for r in out.collect()) == brute(rows, good, toxic)


def test_empty_tables(text_spark):
    docs = text_spark.createDataFrame([], "doc_id bigint, text string, source string")
    labels = text_spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert audit.audit(audit.failure_cells(docs, labels)).count() == 0
    one = text_spark.createDataFrame([(1, "x", "s")], docs.schema)
    assert audit.audit(audit.failure_cells(one, labels)).count() == 600


def test_survivors_of_all_sets():
    rng = np.random.default_rng(2)
    masks, counts = np.arange(16), rng.integers(0, 9, (16, 3))
    states = audit.survivors(masks, counts, 4)
    for s in range(16):
        assert (states[s] == counts[(masks & s) == 0].sum(axis=0)).all()


def test_long_texts_by_code_points():
    assert audit.own_failures(("é" * 97 + "AB").encode()) == 0b101
    assert audit.own_failures(("é" * 98 + "AB").encode()) == 0b001
