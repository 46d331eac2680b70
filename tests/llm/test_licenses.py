import random
import re

from rinkframe.llm import licenses


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def places(text):
    w, out = words(text), []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    return sorted(out)


def test_places_equal_brute_force():
    rng = random.Random(1)
    pool = "under the mit license apache version 2 cc by nc foo É".split()
    for _ in range(300):
        text = " ".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))
        got, _, _ = licenses.default_automaton().scan(licenses.words_of(text.encode()))
        assert sorted(got) == places(text)


def test_matching_statistics_equal_brute_force():
    a = licenses.Automaton({"a b a": "x"}, [("t", "a b a b b c a"), ("u", "b c a a")])
    runs = [[a.numbers[w.encode()] for w in t.split()] for t in ("a b a", "a b a b b c a", "b c a a")]
    rng = random.Random(2)
    for _ in range(200):
        ids = [rng.randrange(len(a.numbers)) for _ in range(12)]
        for i, (_, length) in enumerate(a.statistics(ids)):
            longest = max(n for n in range(i + 2) for run in runs for k in range(len(run) - n + 1)
                          if run[k:k + n] == ids[i + 1 - n:i + 1])
            assert length == longest


def test_templates_are_chained_and_odd_rows_defined(documents):
    _, mit = licenses.TEMPLATES[0]
    edited = mit.replace("without restriction", "with no restriction")
    rows = [(1, mit), (2, "x " * 500 + edited), (3, None), (4, ""), (5, "Under the MIT-License!"), (5, "mit license"),
            (6, "the quick permission notice " * 2000)]
    out = {(r["doc_id"], r["text"]): r for r in
           licenses.scan(documents(rows)).select("doc_id", "text", "license.*").collect()}
    assert len(out) == len(rows)
    assert out[1, mit]["labels"] == "mit" and out[1, mit]["score"] == 1.0
    assert out[rows[1]]["labels"] == "mit" and out[rows[1]]["spans"][0]["first"] == 500
    assert out[3, None]["n_words"] == 0 and out[3, None]["labels"] == "" and out[3, None]["first_word"] is None
    assert out[rows[4]]["base_labels"] == "mit" and out[rows[4]]["first_word"] == 0
    assert out[rows[5]]["labels"] == "" and out[rows[6]]["labels"] == ""
    assert licenses.scan(documents([])).count() == 0
