import random
import zlib

import pytest

from rinkframe.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    return public_tokenizers.path("word_bpe_49k.json")


def texts():
    rng = random.Random(4)
    pool = "the of Ünder ÉCOLE don't it's 42 1999 naïve, <|endoftext|> x̱ H̱ ŉ İstanbul a\u00a0b tab\there".split(" ")
    rows = [(k, " ".join(rng.choice(pool) for _ in range(rng.choice((0, 3, 80, 700))))) for k in range(60)]
    return rows + [(100, None), (101, ""), (102, "word " * 9000), (103, "  \n\t "), (5, rows[5][1]), (None, "x")]


def test_every_token_lies_in_one_piece(text_spark, documents, tokenizer):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer)
    rows = texts()
    out = packing.pack(documents(rows).repartition(5, "doc_id"), tokenizer, windows=2).collect()
    sequences, by_doc = {}, {}
    for r in out:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"]), r["doc_tokens"]))
    padding = total = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
        total += at
        padding += 0 if at & (at - 1) == 0 else packing.CAPACITY - at
    assert padding < 0.02 * total
    for doc_id, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        want = b"".join(i.to_bytes(4, "little") for i in ids)
        copies = [t for i, t in rows if i == doc_id]
        got = sorted(by_doc[doc_id])
        assert sum(len(b) for _, b, _ in got) == len(want) * len(copies)
        if len(copies) == 1:
            assert b"".join(b for _, b, _ in got) == want and {n for _, _, n in got} == {len(ids)}


def test_levels_of_leftovers_and_empty_table(documents, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 2)
    rows = [(k, "some words " * (k % 30)) for k in range(200)]
    out = packing.pack(documents(rows).repartition(9, "doc_id"), tokenizer, windows=3, capacity=64)
    got = out.collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)
    tokens = {r["doc_id"]: r["doc_tokens"] for r in got}
    assert sum(r["length"] for r in got) == sum(tokens.values())
    assert packing.pack(documents([]), tokenizer).count() == 0
