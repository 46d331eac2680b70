import hashlib
import random

from pyspark.sql import functions as F

from rinkframe.llm import linededup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, line, edits):
    chars = list(line)
    for _ in range(edits):
        p, kind = rng.randrange(len(chars)), rng.random()
        if kind < 0.4:
            chars[p] = rng.choice("abcdé")
        elif kind < 0.7:
            chars.insert(p, rng.choice("abcdé"))
        else:
            del chars[p]
    return "".join(chars)


def corpus():
    rng = random.Random(11)
    lines = ["".join(rng.choice("abcdefgh é.,") for _ in range(rng.choice((10, 29, 31, 45, 90)))) for _ in range(25)]
    rows = []
    for k in range(40):
        mine = [edited(rng, rng.choice(lines), rng.choice((0, 0, 1, 2, 3))) for _ in range(rng.randint(0, 6))]
        rows.append((k, "\n".join(mine)))
    return rows + [(50, None), (51, ""), (52, "\n\n"), (53, "z" * 20000 + "\n" + "z" * 20000)]


def by_hand(rows):
    first, out = {}, {}
    for i, t in sorted(rows):
        kept = []
        for line in (t or "").split("\n"):
            near = len(line) >= 30 and any(
                abs(len(x) - len(line)) <= 2 and (x == line or len(line) < 1000 and distance(x, line) <= 2) for x in first)
            if not near:
                kept.append(line)
            if len(line) >= 30:
                first.setdefault(line, i)
        out[i] = "\n".join(kept) if t is not None else ""
    return out


def test_lines_equal_brute_force(documents):
    rows = corpus()
    want = by_hand(rows)
    out = linededup.dedup_lines(documents(rows)).collect()
    assert len(out) == len(rows)
    assert {r["doc_id"]: r["text"] for r in out} == want
    assert set(documents([]).columns) < set(out[0].__fields__)


def test_no_python_in_the_plan(documents):
    df = linededup.dedup_lines(documents([(1, "x" * 40)]))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_rows_and_empty_tables(documents):
    line = "a line that is long enough to be looked at"
    rows = [(2, line), (2, line), (None, line), (3, line + "\nshort"), (1, "short\n" + line)]
    out = sorted((r["doc_id"] or 0, r["text"]) for r in linededup.dedup_lines(documents(rows)).collect())
    assert out == [(0, line), (1, "short"), (2, ""), (2, ""), (3, "short")]
    kept = linededup.keep_distinct_lines(documents(rows))
    assert kept.columns == documents([]).columns and [r["doc_id"] for r in kept.collect()] == [None]
    assert linededup.dedup_lines(documents([])).count() == 0


def test_bit_parallel_distance(text_spark):
    rng = random.Random(12)
    rows = []
    for _ in range(400):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(4, 60)))
        b = edited(rng, a, rng.randint(0, 4))
        if abs(len(a) - len(b)) <= 2 and len(b) > 2:
            rows.append((a, b))
    df = text_spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", linededup.edit_distance(F.split("a", ""), F.split("b", ""), F.length("a")).alias("d"))
    for r in got.collect():
        d = distance(r["a"], r["b"])
        assert r["d"] == d if d <= 2 else r["d"] > 2
    assert hashlib.sha256(b"").hexdigest()


def whole_by_hand(rows):
    """Every line that is not blank takes part; one edit for 15 characters of the shorter line."""
    first, out = [], {}
    for i, t in sorted(rows):
        kept = []
        for line in (t or "").split("\n"):
            gone = line.strip() and any(
                x == line or abs(len(x) - len(line)) <= 2
                and distance(x, line) <= min(2, min(len(x), len(line)) // 15) for x in first)
            if not gone:
                kept.append(line)
            if line.strip() and line not in first:
                first.append(line)
        out[i] = "\n".join(kept)
    return out


def test_short_lines_take_part(documents):
    rng = random.Random(17)
    lines = ["".join(rng.choice("abcdefgh é.,") for _ in range(n)) for n in (3, 9, 14, 15, 16, 28, 29, 30, 31, 32, 45)]
    rows = [(k, "\n".join(edited(rng, rng.choice(lines), rng.choice((0, 1, 2))) for _ in range(rng.randint(0, 6)))
             + "\n" + rng.choice(("a", "if", "b")))
            for k in range(60)]
    rows += [(70, "All rights reserved.\n\n \nfirst"), (71, "second\nAll rights reserved.\n\n ")]
    out = linededup.dedup_lines(documents(rows), least_chars=1).collect()
    got = {r["doc_id"]: r["text"] for r in out}
    assert got == whole_by_hand(rows)
    assert got[71] == "second\n\n "


def test_documents_of_short_lines_stay(documents):
    notice = "This notice stands under every one of these poems."
    rows = [(1, notice), (2, "roses are red\nviolets are blue\n" + notice), (3, notice + "\n\n"),
            (4, notice + "\nroses are red")]
    kept = linededup.keep_distinct_lines(documents(rows), least_chars=1).collect()
    assert {r["doc_id"]: r["text"] for r in kept} == {1: notice, 2: "roses are red\nviolets are blue"}


def test_a_line_is_split_once_for_its_distance(text_spark):
    df = text_spark.createDataFrame([("abcdef", "abcdeg")], "a string, b string")
    out = df.select(linededup.edit_distance(F.split("a", ""), F.split("b", ""), F.length("a")).alias("d"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2 and plan.count("length(") == 1


def test_texts_are_split_once_for_their_lines(documents):
    lines = linededup._all_lines(documents([(1, "x\ny")]), "doc_id", "text", 1)
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_long_lines_have_few_keys(text_spark):
    rng = random.Random(18)
    rows = [(n, n, "".join(rng.choice("abcdé𝄞 ") for _ in range(n))) for n in range(14, 400)]
    keys = linededup.key_rows(text_spark.createDataFrame(rows, "h1 long, h2 long, line string"), least=1).collect()
    assert {r["n"] for r in keys} == set(range(15, 400)) and all(r["h1"] == r["n"] for r in keys)
    assert sum(r["n"] >= 66 for r in keys) < 6 * (400 - 66)


def test_lengths_where_segments_change_size(documents):
    rng = random.Random(19)
    lines = ["".join(rng.choice("abcdefgh é.,𝄞") for _ in range(n)) for n in (63, 64, 65, 66, 79, 80, 81, 96, 97, 128, 161)]
    rows = [(k, "\n".join(edited(rng, line, rng.choice((0, 1, 2, 2, 3))) for line in rng.sample(lines, 6)))
            for k in range(40)]
    out = linededup.dedup_lines(documents(rows), least_chars=1).collect()
    assert {r["doc_id"]: r["text"] for r in out} == whole_by_hand(rows)
