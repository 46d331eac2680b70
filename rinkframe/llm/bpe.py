"""BPE encoding with a lexicon of frequent words, and decoding.

The words of the corpus are counted, the frequent ones encoded once and compiled into a
minimal acyclic transducer (``lexicon``), a file that every executor maps. Texts are then
encoded word by word: a word in the lexicon gives its ids, any other is merged by the
tokenizer itself, so ids never depend on what the lexicon holds.

Defined cases: a null or empty text has no ids and decodes to an empty text; very long
texts are read whole, in groups of bounded size; ties in a count fall on either side of
the lexicon's bound without any effect on ids; an empty corpus gives an empty lexicon; a
column of the result's name is replaced, all others stay as they are.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rinkframe.llm.align import byte_of_letter
from rinkframe.llm.lexicon import Lexicon, compile_lexicon
from rinkframe.llm.store import keep, shared_root
from rinkframe.llm.words import utf8

# Words in the lexicon at most, and the longest of them in bytes.
LEXICON_WORDS = 150_000
LONGEST = 64
# Distinct words that a counting task holds before it passes them on.
COUNTED = 500_000
# Texts are encoded in groups of about this many bytes.
GROUP_BYTES = 4_000_000
# Merged words that a task remembers, with no effect on results.
REMEMBERED = 200_000
# A frequency falls into one of these many classes per doubling.
CLASSES = 8

# A mark after an ASCII capital can compose with it, before it is lower-cased.
_MARKS = re.compile("[̀-ͯ]")


def words_of(text: bytes) -> list[bytes]:
    """Pieces of a text that are encoded each for itself.

    The vocabulary's splitter lets no token reach over white space. A-Z are lower-cased
    first, as its normalizer does, unless a mark or a special token's bracket could make
    that differ.
    """
    if b"<|" in text or not text.isascii() and _MARKS.search(text.decode()):
        return text.split()
    return text.lower().split()


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


# What the fast merger stands for: the vocabulary's normalizer and splitter, as fixed values.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
              {"type": "Lowercase"}]
SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Words of printable ASCII and Latin-1 letters without capitals, which the normalizer leaves
# as they are, and the same splitter over them.
_PLAIN = re.compile("[!-@\\[-~ß-öø-ÿ]+")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class Merger:
    """Ids of words that no lexicon holds, as little-endian unsigned 32-bit.

    Plain words (printable ASCII and Latin-1 letters, no capitals) are cut as the vocabulary's splitter
    cuts them and merged by a faster library, with a line feed for the mark of a word's
    end: a byte that no word holds. That is the same merging if ids are ranks (single
    letters, letters that end a word, then merges in order), which is looked up in the
    file; else, and for all other words, the vocabulary's own library does it.
    """

    def __init__(self, path: str):
        self.path, self.fast = path, None
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        special = {t["content"] for t in whole["added_tokens"]}
        steps = (whole["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        letters = byte_of_letter()
        alike = (
            (whole["normalizer"] or {}).get("normalizers") == NORMALIZER and end
            and steps[0].get("pattern") == {"Regex": SPLITTER}
            and all(vocab.get(a + b) == 512 + k for k, (a, b) in enumerate(merges))
            and {vocab.get(c) for c in letters} == set(range(256))
            and {vocab.get(c + end) for c in letters} == set(range(256, 512)))
        if not alike:
            return
        ranks = {}
        for token, i in vocab.items():
            if token not in special:
                stem = token.removesuffix(end) if i >= 256 else token
                ranks[bytes(letters[c] for c in stem) + (b"\n" if stem != token else b"")] = i
        # A token that holds a line feed of its own would be taken for the end of a word.
        if len(ranks) == 512 + len(merges) and all(b"\n" not in r[:-1] or r == b"\n\n" for r in ranks):
            import tiktoken

            self.fast = tiktoken.Encoding("words", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={})
            self.ends = np.zeros(max(ranks.values()) + 1, bool)
            self.ends[[i for r, i in ranks.items() if r.endswith(b"\n")]] = True

    def ids(self, words: list[bytes]) -> Iterator[bytes]:
        """Ids of every word, in order."""
        texts = [w.decode() for w in words]
        plain = [self.fast is not None and _PLAIN.fullmatch(t) is not None and "<|" not in t for t in texts]
        rest = [t for t, p in zip(texts, plain) if not p]
        slow = iter(tokenizer(self.path).encode_batch_fast(rest, add_special_tokens=False) if rest else [])
        pieces = [_PIECES.findall(t) for t, p in zip(texts, plain) if p]
        if pieces:
            joined = "\n".join([p for cut in pieces for p in cut]) + "\n"
            ids = np.array(self.fast.encode_ordinary(joined), "<u4")
            upto = np.append(0, np.flatnonzero(self.ends[ids]) + 1)[np.cumsum([0] + [len(p) for p in pieces])]
            data, cuts = ids.tobytes(), iter((4 * upto).tolist())
            at = next(cuts)
        for p in plain:
            if p:
                begin, at = at, next(cuts)
                yield data[begin:at]
            else:
                yield np.array(next(slow).ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


def merged(path: str, words: list[bytes]) -> list[bytes]:
    """Ids of words, in slices of bounded size."""
    work = merger(path)
    return [i for k in range(0, len(words), 10_000) for i in work.ids(words[k:k + 10_000])]


def _check(path: str) -> None:
    """Encoding word by word needs a splitter that drops white space and BPE inside words."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    steps = (whole["pre_tokenizer"] or {}).get("pretokenizers", [])
    drops = any(s.get("type") == "Split" and s.get("behavior") == "Removed" for s in steps)
    if whole["model"]["type"] != "BPE" or not drops or whole["post_processor"] is not None:
        raise ValueError(f"{path} is no vocabulary of words with ends")


def grouped(texts: list[bytes], size: int = GROUP_BYTES) -> Iterator[list[bytes]]:
    group, n = [], 0
    for t in texts:
        group.append(t)
        n += len(t)
        if n >= size:
            yield group
            group, n = [], 0
    if group:
        yield group


class Encoder:
    """Encodes texts of one task."""

    def __init__(self, path: str, lexicon: Lexicon | None):
        self.path, self.lexicon = path, lexicon
        self.known: dict[bytes, bytes] = {}

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of all words of a group; those merged here are remembered."""
        found = {}
        if self.lexicon is not None:
            listed = list(words)
            places = self.lexicon.places(listed)
            found = {listed[k]: self.lexicon.ids_at(places[k]) for k in (places >= 0).nonzero()[0].tolist()}
        rest = [w for w in words if w not in found]
        new = [w for w in rest if w not in self.known]
        found.update((w, self.known[w]) for w in rest if w in self.known)
        found.update(zip(new, merged(self.path, new)))
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
        self.known.update((w, found[w]) for w in new[:REMEMBERED] if len(w) <= LONGEST)
        return found

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of every text, in order."""
        for group in grouped(texts):
            split = [words_of(t) for t in group]
            table = self._learn(set().union(*split))
            for words in split:
                yield b"".join(map(table.__getitem__, words))


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``word, n`` of all texts. Tasks count first, so a frequent word is no hot key."""
    def count(batches):
        seen: Counter = Counter()

        def passed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return batch

        for batch in batches:
            for t in utf8(batch.column(0)):
                seen.update(w for w in words_of(t) if len(w) <= LONGEST)
                if len(seen) >= COUNTED:
                    yield passed()
        yield passed()

    return (df.select(F.col(text).alias("text")).mapInArrow(count, "word binary, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")))


def frequent_words(df: DataFrame, text: str = "text", most: int = LEXICON_WORDS) -> DataFrame:
    """``word``: the most frequent words, ``most`` at most and whole classes of frequency.

    The bound is found from the sizes of the classes (a few hundred rows), without a sort
    of all words.
    """
    counts = keep(word_counts(df, text), "word-counts").withColumn(
        "class", F.floor(F.log2("n") * CLASSES))
    sizes = sorted((tuple(r) for r in counts.groupBy("class").count().collect()), reverse=True)
    room, least = most, None
    for kind, n in sizes:
        if n > room:
            break
        room, least = room - n, kind
    return counts.filter(F.col("class") >= least if least is not None else F.lit(False)).select("word")


def build_lexicon(df: DataFrame, path: str, text: str = "text", most: int = LEXICON_WORDS) -> str:
    """Compile the frequent words of a corpus; the name of the file sent to executors.

    At most ``most`` words of at most ``LONGEST`` bytes reach the driver with their ids.
    The file is written to the shared folder, and every executor, a replaced one as well,
    fetches it from there once.
    """
    _check(path)

    def coded(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(merged(path, batch.column(0).to_pylist()), pa.binary())],
                ["word", "ids"])

    spark = df.sparkSession
    rows = frequent_words(df, text, most).mapInArrow(coded, "word binary, ids binary").toArrow()
    entries = {
        w: [int.from_bytes(i[k:k + 4], "little") for k in range(0, len(i), 4)]
        for w, i in zip(rows.column("word").to_pylist(), rows.column("ids").to_pylist())}
    name = f"lexicon-{uuid.uuid4().hex}"
    target = f"{shared_root(spark)}/rinkframe-llm/{name}"
    _write(spark, target, compile_lexicon(entries))
    spark.sparkContext.addFile(target)
    return name


def _write(spark: SparkSession, target: str, data: bytes) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    for k in range(0, len(data), 1 << 20):
        out.write(data[k:k + (1 << 20)])
    out.close()


@lru_cache(maxsize=1)
def _mapped(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


def encode(df: DataFrame, path: str, *, text: str = "text", out: str = "ids",
           lexicon: str | None = None) -> DataFrame:
    """Add the token ids of a text, little-endian unsigned 32-bit in one binary.

    ``path`` is the vocabulary's file on every executor; ``lexicon`` the name that
    ``build_lexicon`` gave (without one every word is merged).
    """
    _check(path)

    @F.arrow_udf("binary")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(path, _mapped(lexicon) if lexicon else None)
        for batch in batches:
            yield pa.array(list(encoder.ids(list(utf8(batch)))), pa.binary())

    return df.withColumn(out, coded(F.col(text)))


def decode(df: DataFrame, path: str, *, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of token ids: the vocabulary's tokens with a space between them.

    The vocabulary has no decoder of its own; ids that it does not know give nothing.
    """
    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = tokenizer(path)
        tokens = {i: t for t, i in own.get_vocab(with_added_tokens=True).items()}
        for batch in batches:
            yield pa.array([
                " ".join([tokens[i] for i in np.frombuffer(b or b"", "<u4").tolist() if i in tokens])
                for b in batch.to_pylist()], pa.string())

    with open(path, encoding="utf-8") as file:
        if json.load(file)["decoder"] is not None:
            raise ValueError(f"{path} has a decoder of its own")
    return df.withColumn(out, texts(F.col(ids)))
