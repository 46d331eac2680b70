import random

from rinkframe.llm import decontam

POOL = ("time year people way day man thing woman life child world school state family student group "
        "country problem hand part place case week company system program question work government number").split()


def sentence(rng, n):
    return " ".join(rng.choice(POOL) for _ in range(n))


def test_planted_edits_are_found_and_clean_texts_left():
    rng = random.Random(13)
    items = [(k, decontam.normalised(sentence(rng, rng.choice((5, 12, 40))).encode())) for k in range(30)]
    items = [x for x in items if len(x[1]) >= decontam.LEAST_ITEM]
    index = decontam.Index(items)
    for k, (item_id, text) in enumerate(items * 4):
        k %= len(items)
        region, edits = int(index.region[k]), int(index.edits[k])
        at = rng.randint(0, len(text) - region)
        piece = bytearray(text[at:at + region])
        for _ in range(edits):
            p = rng.randrange(len(piece))
            piece[p:p + rng.randint(0, 1)] = rng.choice((b"", b"q", b"z"))
        clean = sentence(rng, 200)
        found = {r[1] for r in decontam.search([(clean[:300] + " " + piece.decode() + " " + clean[300:]).encode()], index)}
        assert item_id in found
        assert not decontam.search([sentence(rng, 60).encode()], index)


def test_long_texts_and_case_and_marks():
    rng = random.Random(14)
    item = "What is the capital of the country, and how many people live there today? École."
    index = decontam.Index([(7, decontam.normalised(item.encode()))])
    text = sentence(rng, 60000) + " -- " + item.upper().replace(" ", "\n* ") + sentence(rng, 100)
    assert [(r[0], r[1]) for r in decontam.search([b"", text.encode(), text.encode()], index)] == [(1, 7), (2, 7)]


def test_odd_rows_and_several_passes(text_spark, documents):
    rng = random.Random(15)
    texts = [sentence(rng, 20) for _ in range(12)]
    bench = text_spark.createDataFrame(
        [(k, t, 1) for k, t in enumerate(texts)] + [(20, None, 1), (21, "tiny", 1), (None, texts[0], 1), (0, texts[0], 1)],
        "item_id bigint, text string, doc_id int")
    rows = [(1, "x " + texts[0]), (1, "x " + texts[0]), (2, None), (3, ""), (4, "tiny"), (5, texts[3] + " y " + texts[4]), (6, sentence(rng, 90))]
    for size in (decontam.MAX_BYTES, 200):
        out = decontam.leaks(documents(rows), bench, max_bytes=size).select("doc_id", "item_id").distinct().collect()
        assert sorted(map(tuple, out)) == [(1, 0), (5, 3), (5, 4)]
    left = decontam.drop_leaks(documents(rows), bench)
    assert left.columns == documents([]).columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4, 6]
    assert decontam.leaks(documents([]), bench).count() == 0
    assert decontam.leaks(documents(rows), bench.limit(0)).count() == 0


def test_alignment_equals_brute_force():
    rng = random.Random(16)
    for _ in range(150):
        w = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 12)))
        t = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 14)))
        rows = [[0] * (len(t) + 1)]
        for i, c in enumerate(w, 1):
            row = [i]
            for j, d in enumerate(t, 1):
                row.append(min(row[-1] + 1, rows[-1][j] + 1, rows[-1][j - 1] + (c != d)))
            rows.append(row)
        assert decontam.aligned_edits(w, t, 5) == min(min(rows[-1]), 6)


def ends_within(window, text, edits):
    """Ends in the text, and edits, of the stretches that ``window`` can be turned into."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(window, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (c != d)))
        row = new
    return [(j, e) for j, e in enumerate(row) if e <= edits]


def leak_by_hand(item, text):
    """regions, chars and edits from every window of the item at every place."""
    region = min(len(item), decontam.REGION)
    edits = region // decontam.CHARS_PER_EDIT
    places = [(a, j - region - a) for a in range(len(item) - region + 1)
              for j, _ in ends_within(item[a:a + region], text, edits)]
    groups = []
    for p in places:
        mine = [g for g in groups if any(abs(x[0] - p[0]) <= region and abs(x[1] - p[1]) <= 2 * edits + 1 for x in g)]
        groups = [g for g in groups if g not in mine] + [[p] + [x for g in mine for x in g]]
    if not groups:
        return None
    spans = [(min(a for a, _ in g), max(a for a, _ in g) + region) for g in groups]
    chars = len({c for a, b in spans for c in range(a, b)})
    least = min(e for a, b in spans for _, e in ends_within(item[a:b], text, b - a))
    return len(groups), chars, least


def test_all_columns_equal_brute_force(text_spark, documents):
    rng = random.Random(18)
    long, short = (decontam.normalised(sentence(rng, 60).encode())[:n].strip().decode() for n in (227, 110))
    before, after = sentence(rng, 8), sentence(rng, 6)
    texts = [f"{before} {long} {after}", f"{before} {long[:120]} {after} {long[120:]}", f"{long} {after} {long}",
             f"{before} {short} {after}", f"{before} {long[:60]}q{long[60:150]}z{long[151:]} {after}",
             f"{long[100:]} {before} {long[:110]}", f"{before} {after}", f"{long[:95]} {short[5:]}"]
    bench = text_spark.createDataFrame([(1, long), (2, short)], "item_id bigint, text string")
    want = set()
    for i, t in enumerate(texts):
        for item_id, item in ((1, long), (2, short)):
            if (hand := leak_by_hand(item.encode(), decontam.normalised(t.encode()))) is not None:
                want.add((i, item_id, *hand))
    assert (0, 1, 1, len(long), 0) in want and (2, 1, 2, len(long), 0) in want
    got = {tuple(r) for r in decontam.leaks(documents(list(enumerate(texts))), bench)
           .select("doc_id", "item_id", "regions", "chars", "edits").collect()}
    assert got == want


def test_regions_over_the_edge_of_a_chunk():
    rng = random.Random(19)
    item = decontam.normalised(sentence(rng, 70).encode())[:300].strip()
    index = decontam.Index([(7, item)])
    for at in (decontam.CHUNK - 600, decontam.CHUNK - 400, decontam.CHUNK - 100):
        text = decontam.normalised(sentence(rng, 60000).encode())[:at].strip() + b" " + item + b" tail " + sentence(rng, 200).encode()
        assert decontam.search([text], index) == [(0, 7, 1, len(item), 0)]
