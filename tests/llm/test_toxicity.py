import random

from rinkframe.llm import toxicity


def corpus(n=800):
    rng = random.Random(5)
    pool = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)]
    rows, labels = [], []
    for k in range(n):
        words = [rng.choice(pool) for _ in range(rng.randint(5, 120))]
        toxic = k % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(("vilish", "vilest", "viling"))
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_sparsity(text_spark, documents):
    rows, labels = corpus()
    train = text_spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id bigint, toxic int")
    model = toxicity.fit(documents(rows), train)
    out = {r["doc_id"]: r["score"] for r in toxicity.score(documents(rows), model).select("doc_id", "score").collect()}
    held = [(out[k], y) for k, y in labels if k % 3 == 0]
    assert sum((s >= 0.5) == bool(y) for s, y in held) > 0.95 * len(held)
    assert 0 < len(model.places) < 3000


def test_odd_rows_and_labels(text_spark, documents):
    rows = [(1, None), (2, ""), (3, "é " * 20000), (4, "a"), (4, "a"), (None, "b")]
    labels = text_spark.createDataFrame([(1, None), (4, 1), (4, 0), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(documents(rows), labels)
    out = toxicity.score(documents(rows), model).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["text"] == "a"}) == 1
    none = toxicity.fit(documents(rows), labels.limit(0))
    assert {r["score"] for r in toxicity.score(documents(rows), none).collect()} == {0.5}
    assert toxicity.score(documents([]), model).count() == 0


def test_ftrl_keeps_unused_weights_at_zero():
    import numpy as np

    model = toxicity.Ftrl(bits=10)
    for _ in range(60):
        model.learn(np.array([1, 7]), 1)
        model.learn(np.array([2, 7]), 0)
    w = model.weights(slice(None))
    assert w[1] > 0 > w[2] and np.count_nonzero(w) <= 3


def test_weights_equal_a_plain_fit(text_spark, documents):
    """Against FTRL-proximal on dicts, one coordinate at a time; labels without a document
    do not use the sample up."""
    import math

    rows, labels = corpus(240)
    unmatched = [(k, 1) for k in range(10_000, 10_400)]
    frame = text_spark.createDataFrame(labels + unmatched, "doc_id bigint, toxic int")
    model = toxicity.fit(documents(rows), frame, max_rows=240, epochs=2)

    turn = text_spark.range(240).selectExpr("id", "xxhash64(id, 1) AS turn").collect()
    order = [r["id"] for r in sorted(turn, key=lambda r: r["turn"])]
    features, count = toxicity.Features(), {}
    at = {k: sorted(set(features.of(t.encode()).tolist())) for k, t in rows}
    for places in at.values():
        for p in places:
            count[p] = count.get(p, 0) + 1
    y, z, n = dict(labels), {}, {}
    share = sum(y.values()) / len(y)
    bias, bias_n = math.log(share / (1 - share)), 0.0

    def weight(p):
        if abs(z.get(p, 0.0)) <= 5.0:
            return 0.0
        return -(z[p] - math.copysign(5.0, z[p])) / ((1 + math.sqrt(n[p])) / 0.5 + 0.1)

    for _ in range(2):
        for k in order:
            mine = [p for p in at[k] if count[p] >= toxicity.LEAST_TEXTS]
            w = {p: weight(p) for p in mine}
            g = 1 / (1 + math.exp(-(sum(w.values()) + bias))) - y[k]
            g *= 3.0 if y[k] else 1.0
            for p in mine:
                grown = n.get(p, 0.0) + g * g
                z[p] = z.get(p, 0.0) + g - (math.sqrt(grown) - math.sqrt(n.get(p, 0.0))) / 0.5 * w[p]
                n[p] = grown
            bias_n += g * g
            bias -= 0.5 * g / (1 + math.sqrt(bias_n))
    want = {p: weight(p) for p in z if weight(p)}
    got = dict(zip(model.places.tolist(), model.weights.tolist()))
    assert got.keys() == want.keys() and len(want) > 3
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want) and abs(model.bias - bias) < 1e-9
