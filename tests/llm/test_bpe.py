import random

import pytest

from rinkframe.llm import bpe
from rinkframe.llm.lexicon import Lexicon, compile_lexicon

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("word_bpe_49k.json")


def texts():
    rng = random.Random(4)
    pool = ("the of Ünder ÉCOLE don't it's 42 1999 naïve, <|endoftext|> <|ENDOFTEXT|> x<|startoftext|>y x̱ H̱ ŉ "
            "İstanbul a b tab\there a\x00b 日本語 ́lone ﬁ Å   � 🏒🏒").split(" ")
    rows = [(k, " ".join(rng.choice(pool) for _ in range(rng.choice((0, 3, 80, 700))))) for k in range(60)]
    return rows + [(100, None), (101, ""), (102, "word " * 9000), (103, "  \n\t "), (104, "ab" * 5000),
                   (5, rows[5][1]), (None, "x")]


def test_lexicon_gives_every_word_its_ids_and_no_other(tmp_path):
    rng = random.Random(1)
    made = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))).encode() for _ in range(400)}
    entries = {w: [rng.randrange(49408) for _ in range(rng.randint(0, 4))] for w in made | {b""}}
    file = tmp_path / "lexicon"
    file.write_bytes(compile_lexicon(entries))
    lexicon = Lexicon(str(file))
    asked = [*entries, *(w + b"a" for w in entries), *(w[:-1] for w in entries), b"zzz", b"\xff"]
    for word, place in zip(asked, lexicon.places(asked).tolist()):
        assert (place >= 0) == (word in entries)
        if place >= 0:
            assert lexicon.ids_at(place) == b"".join(i.to_bytes(4, "little") for i in entries[word])
    assert sorted(lexicon.places(list(entries)).tolist()) == list(range(len(entries)))


def test_lexicon_shares_suffixes(tmp_path):
    heads = [bytes([c]) for c in b"abcdefgh"]
    file = tmp_path / "lexicon"
    file.write_bytes(compile_lexicon({h + b"suffix": [1] for h in heads}))
    assert len(Lexicon(str(file)).keys) == len(heads) + len(b"suffix")


def test_empty_lexicon(tmp_path):
    file = tmp_path / "lexicon"
    file.write_bytes(compile_lexicon({}))
    assert Lexicon(str(file)).places([b"a", b""]).tolist() == [-1, -1]


@pytest.mark.parametrize("most", [0, 12, 100_000])
def test_ids_and_texts_are_the_tokenizers(text_spark, documents, path, most):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    rows = texts()
    docs = documents(rows).withColumnRenamed("code", "ids").repartition(3)
    lexicon = bpe.build_lexicon(docs, path, most=most)
    coded = bpe.encode(docs, path, lexicon=lexicon)
    out = bpe.decode(coded, path).collect()
    assert set(coded.columns) == set(docs.columns)  # the clashing column is replaced
    got = sorted((str(r["doc_id"]), r["text"] or "", bytes(r["ids"]), r["decoded"]) for r in out)
    want = []
    for doc_id, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids
        want.append((str(doc_id), text or "", b"".join(i.to_bytes(4, "little") for i in ids),
                     plain.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)


def test_without_a_lexicon_and_empty_table(documents, path):
    docs = documents([(1, "The Cat"), (2, None)])
    ids = {r["doc_id"]: bytes(r["ids"]) for r in bpe.encode(docs, path).collect()}
    assert len(ids[1]) == 8 and ids[2] == b""
    none = documents([])
    assert bpe.encode(none, path, lexicon=bpe.build_lexicon(none, path)).count() == 0


def test_frequent_words_are_whole_classes_within_the_bound(documents):
    docs = documents([(1, "a " * 64 + "b " * 16 + "c c d e")] * 2)
    for most, want in ((0, set()), (1, {b"a"}), (3, {b"a", b"b", b"c"}), (4, {b"a", b"b", b"c"}), (9, set(b"a b c d e".split()))):
        assert {bytes(r["word"]) for r in bpe.frequent_words(docs, most=most).collect()} == want


def test_both_mergers_agree(path):
    """Words of every class of characters, merged fast and by the vocabulary's own library."""
    rng = random.Random(9)
    pool = "abcdefghijklmnopqrstuvwxyz''smtdlvr0123456789.,-_\"!/<|>~éüßñçøÿÉ×÷ª²\u00ad\u0301İıſǅ日я\x00\x7f"
    words = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 12))).encode() for _ in range(20_000)]
    words += [b"it's", b"x'stuff", b"''ll", b"<|endoftext|>", b"a" * 5000, b"'", b"\xc3\xa9'll"]
    coder = bpe.Merger(path)
    assert coder.fast is not None
    want = bpe.tokenizer(path).encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
    assert list(coder.ids(words)) == [b"".join(i.to_bytes(4, "little") for i in e.ids) for e in want]
    coder.fast = None
    assert list(coder.ids(words[:500])) == bpe.merged(path, words[:500])


def test_memory_of_merged_words_has_no_effect(path, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    rows = [(t or "").encode() for _, t in texts()]
    assert list(bpe.Encoder(path, None).ids(rows)) == [next(bpe.Encoder(path, None).ids([t])) for t in rows]
