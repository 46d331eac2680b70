import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rinkframe.llm import align
from rinkframe.llm.store import keep

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def paths():
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def texts():
    rng = random.Random(6)
    pool = ("the of Ünder don't 42 1999 naïve, <|endoftext|> <s> </s> <0x41> 日本語 🏒🏒 a b tab\there "
            "line\nline\n\n indent ́x a\x00b ﬁ ...!!! CamelCaseWord http://a.b/c?d=e").split(" ")
    rows = [(k, rng.choice((" ", "  ", "\n")).join(rng.choice(pool) for _ in range(rng.choice((1, 5, 60, 400)))))
            for k in range(50)]
    return rows + [(100, None), (101, ""), (102, " "), (103, "  lead"), (104, "holds ▁ itself"), (105, "ab" * 4000),
                   (106, "word " * 9000), (107, "日本" * 3000), (3, rows[3][1]), (None, "x y")]


def ids_and_bytes(text, paths):
    """Tokens of both sides as (id, bytes), straight from the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(paths[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    letters = align.byte_of_letter()
    found = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(letters[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(t for _, t in left) != whole or b"".join(t for _, t in right) != whole:
        return [], []
    return left, right


def spans(tokens):
    out, at = [], 0
    for i, t in tokens:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def brute(text, paths):
    left, right = map(spans, ids_and_bytes(text, paths) if text else ([], []))
    cuts = sorted({e for _, _, e in left} & {e for _, _, e in right})
    groups, i, j = [], 0, 0
    for c in cuts:
        k, m = i, j
        while k < len(left) and left[k][2] <= c:
            k += 1
        while m < len(right) and right[m][2] <= c:
            m += 1
        groups.append(",".join(str(x[0]) for x in left[i:k]) + "|" + ",".join(str(x[0]) for x in right[j:m]))
        i, j = k, m
    links, first = Counter(), 0
    for a, s, e in left:
        while first < len(right) and right[first][2] <= s:
            first += 1
        k = first
        while k < len(right) and right[k][1] < e:
            links[a, right[k][0]] += 1
            k += 1
    return len(left), len(right), groups, links


@pytest.mark.parametrize("at_once", [2_000_000, 50])
def test_alignment_and_counts_equal_brute_force(text_spark, documents, paths, at_once, monkeypatch):
    monkeypatch.setattr(align, "GROUP_CHARS", 3000)
    rows = texts()
    width = align.side_size(paths[1])
    docs = documents(rows).withColumnRenamed("code", "pairs").withColumnRenamed("place", "row").repartition(3)
    aligned = keep(align.align(docs, *paths), "test-aligned")
    judged = align.judge_links(aligned, width, at_once)
    got = aligned.join(judged, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)),
        F.coalesce("count_sum", F.lit(0)), "groups").collect()
    made = [(doc_id, *brute(text, paths)) for doc_id, text in rows]
    totals = Counter()
    for m in made:
        totals.update(m[4])
    best = Counter()
    for (a, b), n in totals.items():
        best[b] = max(best[b], n)
    want = [(doc_id, n_a, n_b, len(groups), sum(links.values()),
             sum(n for p, n in links.items() if totals[p] == best[p[1]]),
             sum(n * totals[p] for p, n in links.items()), ";".join(groups))
            for doc_id, n_a, n_b, groups, links in made]
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))
    assert [w[1] for w in want if w[0] in (100, 101, 104)] == [0, 0, 0]


def test_empty_table(documents, paths):
    aligned = keep(align.align(documents([]), *paths), "test-aligned")
    assert aligned.count() == 0 and align.judge_links(aligned, align.side_size(paths[1])).count() == 0


def test_both_libraries_split_and_merge_alike(paths):
    """Every code point, in several places of a word, by the faster library and the file's own."""
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(paths[0])
    own.encode_special_tokens = True
    fast = align.ByteTokens(paths[0])
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 4096):
        text = "".join(f" a{c}1{c}.{c}{c} {c}'s  {c}\n" for c in points[k:k + 4096:7 if k > 0x10000 else 1])
        assert fast.encode([text]) == [own.encode(text, add_special_tokens=False).ids]


def test_groups_are_written_in_order(documents, paths):
    row = align.align(documents([(1, "a bc")]), *paths).first()
    left, right = ids_and_bytes("a bc", paths)
    assert row["groups"] == ";".join(f"{a[0]}|{b[0]}" for a, b in zip(left, right)) and row["n_groups"] == 2
