"""Licence scans with a generalised suffix automaton.

The automaton holds every run of words of all licence templates. Streaming a
text's words through it gives, at each word, the longest template run that ends
there (the matching statistic). A short phrase stands where that run covers it
whole; long runs of one template are chained into spans, and the share of the
template's words they cover is its score.

Defined cases: a null or empty text has no words, no labels and score 0; repeated
rows are scanned each for itself; an empty table gives an empty result; other
columns pass through, and ``license`` replaces a column of that name.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkframe.llm.words import utf8

# Phrases that name a licence outright, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Opening passages of public licences and usual notices.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("all-rights-reserved", "All rights reserved. No part of this publication may be reproduced, distributed or transmitted in any form or by any means"),
]

# A run of a template counts towards its spans from this many words on, and a
# template is reported from this share of its words on.
MIN_RUN = 4
MIN_COVER = 0.8

_LOWER = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and all characters beyond ASCII."""
    return text.translate(_LOWER).split()


class Automaton:
    """Generalised suffix automaton over word numbers.

    State ``s`` stands for a set of runs that end at the same places; ``longest[s]``
    is the length of the longest one and ``link[s]`` the state of the next shorter
    ones. ``ends[s]`` holds the phrases that end where any run of ``s`` ends, and
    ``place[s]`` one (template, position) where the runs of ``s`` end.
    """

    def __init__(self, phrases: dict[str, str], templates: list[tuple[str, str]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.longest, self.place = [-1], [0], [None]
        self.numbers: dict[bytes, int] = {}
        self.phrases = [(tuple(self._number(w) for w in words_of(p.encode())), label)
                        for p, label in phrases.items()]
        self.templates = [(label, [self._number(w) for w in words_of(t.encode())])
                          for label, t in templates]
        whole = {}
        for k, (run, _) in enumerate(self.phrases):
            whole[self._insert(run, None)] = k
        for t, (_, run) in enumerate(self.templates):
            self._insert(run, t)
        self._walk_phrases()
        self.top = len(self.numbers)

    def _number(self, word: bytes) -> int:
        return self.numbers.setdefault(word, len(self.numbers))

    def _insert(self, run, template) -> int:
        last = 0
        for at, c in enumerate(run):
            last = self._extend(last, c)
            if template is not None:
                s = last
                while s > 0 and self.place[s] is None:
                    self.place[s] = (template, at)
                    s = self.link[s]
        return last

    def _state(self, longest: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.longest.append(longest)
        self.place.append(None)
        return len(self.next) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        copy = self._state(self.longest[p] + 1)
        self.next[copy] = dict(self.next[q])
        self.link[copy], self.link[q] = self.link[q], copy
        self.place[copy] = self.place[q]
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.longest[q] == self.longest[last] + 1 else self._split(last, q, c)
        new, p = self._state(self.longest[last] + 1), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.longest[q] == self.longest[p] + 1 else self._split(p, q, c)
        return new

    def _walk_phrases(self) -> None:
        """Note at each state the phrases that are suffixes of its runs."""
        own = [[] for _ in self.next]
        for k, (run, _) in enumerate(self.phrases):
            s = 0
            for c in run:
                s = self.next[s][c]
            own[s].append((len(run), k))
        self.ends = [()] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.longest.__getitem__):
            self.ends[s] = tuple(own[s]) + tuple(self.ends[self.link[s]])

    def statistics(self, ids: list[int]):
        """(state, length) of the longest template run that ends at each word."""
        s, length = 0, 0
        step, link, longest = self.next, self.link, self.longest
        for c in ids:
            while s and c not in step[s]:
                s = link[s]
                length = longest[s]
            if c in step[s]:
                s = step[s][c]
                length += 1
            yield s, length

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], dict[int, list], dict[int, float]]:
        """Places of phrases, and spans and cover of templates, in a text's words."""
        get = self.numbers.get
        ids = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
        known = np.concatenate(([False], ids >= 0, [False]))
        edges = np.flatnonzero(known[1:] != known[:-1])
        found, runs = [], {}
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if hi - lo < 3:
                continue
            stats = list(self.statistics(ids[lo:hi].tolist()))
            for i, (s, length) in enumerate(stats):
                for size, k in self.ends[s]:
                    if size <= length:
                        found.append((lo + i - size + 1, self.phrases[k][1]))
                grows = i + 1 < len(stats) and stats[i + 1][1] == length + 1
                if length >= MIN_RUN and not grows:
                    self._add_runs(runs, ids, lo + i, length)
        cover = {t: self._chained(r, len(self.templates[t][1])) for t, r in runs.items()}
        return found, runs, cover

    def _add_runs(self, runs: dict, ids: np.ndarray, end: int, length: int) -> None:
        """Note a maximal run under every template that has it."""
        run = ids[end - length + 1:end + 1].tolist()
        for t, (_, words) in enumerate(self.templates):
            for at in range(len(words) - length + 1):
                if words[at] == run[0] and words[at:at + length] == run:
                    runs.setdefault(t, []).append((end - length + 1, at, length))

    @staticmethod
    def _chained(runs: list, size: int) -> float:
        """Largest share of a template that runs cover in order, within one stretch."""
        best = []
        for start, at, length in sorted(runs):
            chain = length
            for (s, a, n), total in best:
                if s + n <= start and a + n <= at and start - s <= 2 * size:
                    chain = max(chain, total + length)
            best = [x for x in best if start - x[0][0] <= 2 * size]
            best.append(((start, at, length), chain))
        return min(1.0, max((total for _, total in best), default=0) / size)


@functools.lru_cache(1)
def default_automaton() -> Automaton:
    return Automaton(PHRASES, TEMPLATES)


SCAN_TYPE = ("struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,"
             "base_labels:string,labels:string,score:double,"
             "spans:array<struct<label:string,first:bigint,words:bigint>>>")


def scan_words(words: list[bytes], automaton: Automaton) -> dict:
    found, runs, cover = automaton.scan(words)
    starts = [s for s, _ in found]
    base = {label for _, label in found}
    wide = {automaton.templates[t][0] for t, c in cover.items() if c >= MIN_COVER}
    score = 1.0 if base else max(cover.values(), default=0.0)
    spans = sorted({(automaton.templates[t][0], s, n) for t, r in runs.items()
                    if cover[t] >= MIN_COVER for s, _, n in r})
    return {
        "n_words": len(words), "n_base": len(found),
        "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | wide)),
        "score": float(score),
        "spans": [{"label": label, "first": s, "words": n} for label, s, n in spans],
    }


def _scan_batch(texts: pa.Array) -> pa.Array:
    automaton = default_automaton()
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("words", pa.int64())])
    kind = pa.struct([
        ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
        ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
        ("score", pa.float64()), ("spans", pa.list_(span))])
    return pa.array([scan_words(words_of(b), automaton) for b in utf8(texts)], kind)


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the struct ``license``. One pass, no shuffle; the automaton is a constant."""
    return df.withColumn("license", F.arrow_udf(_scan_batch, SCAN_TYPE)(F.col(text)))
