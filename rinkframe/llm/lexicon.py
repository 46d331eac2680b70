"""A minimal acyclic transducer from words to numbers, in one memory-mapped file.

Words share prefixes and suffixes in one automaton. Every transition carries an output
to add, and the sum along a word's path is its place in sorted order; that place points
to the word's token ids. The file is a few flat arrays, so all workers of a machine that
map it share its pages, and a batch of words walks it together, one byte a step.
"""

from __future__ import annotations

import numpy as np

MAGIC = 0x52464C58
_ARRAYS = (("keys", np.uint64), ("targets", np.uint32), ("adds", np.uint32),
           ("final", np.uint8), ("starts", np.uint32), ("ids", np.uint32))


class _Builder:
    """States of sorted words; a finished state equal to an older one becomes that one."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.states: list[tuple] = []  # (final, ((byte, target), ...))
        self.path: list[list] = [[False, []]]  # unfinished states: [final, transitions]
        self.last = b""

    def _finish(self, depth: int) -> None:
        for k in range(len(self.path) - 1, depth, -1):
            final, moves = self.path.pop()
            self.path[-1][1].append((self.last[k - 1], self._state(final, moves)))

    def _state(self, final: bool, moves: list) -> int:
        key = (final, tuple(moves))
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.states)
            self.states.append(key)
        return found

    def add(self, word: bytes) -> None:
        shared, most = 0, min(len(word), len(self.last))
        while shared < most and word[shared] == self.last[shared]:
            shared += 1
        self._finish(shared)
        self.path.extend([False, []] for _ in range(len(word) - shared))
        self.path[-1][0], self.last = True, word

    def done(self) -> int:
        self._finish(0)
        return self._state(*self.path.pop())


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The file for these words and their token ids."""
    builder, words = _Builder(), sorted(entries)
    for word in words:
        builder.add(word)
    root = builder.done()
    states = builder.states
    below = np.zeros(len(states), np.int64)  # words that end in or under a state
    keys, targets, adds = [], [], []
    for state, (final, moves) in enumerate(states):  # targets come before their sources
        count = int(final)
        for byte, target in moves:
            keys.append(state << 8 | byte)
            targets.append(target)
            adds.append(count)
            count += int(below[target])
        below[state] = count
    sizes = [len(entries[w]) for w in words]
    arrays = {
        "keys": keys, "targets": targets, "adds": adds, "final": [s[0] for s in states],
        "starts": np.cumsum([0, *sizes]), "ids": [i for w in words for i in entries[w]]}
    blocks = [np.asarray(arrays[name], kind) for name, kind in _ARRAYS]
    head = np.array([MAGIC, root, *(len(b) for b in blocks)], np.uint64)
    return head.tobytes() + b"".join(b.tobytes() + bytes(-b.nbytes % 8) for b in blocks)


class Lexicon:
    """A compiled file, mapped read-only."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        head = data[:8 * (2 + len(_ARRAYS))].view(np.uint64).tolist()
        if head[0] != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        self.root, at = head[1], 8 * len(head)
        for (name, kind), n in zip(_ARRAYS, head[2:]):
            size = n * np.dtype(kind).itemsize
            setattr(self, name, data[at:at + size].view(kind))
            at += size + -size % 8

    def __len__(self) -> int:
        return len(self.starts) - 1

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of every word, -1 for one that is not in the lexicon."""
        out = np.full(len(words), -1, np.int64)
        if not words or not len(self):
            return out
        sizes = np.array([len(w) for w in words], np.int64)
        order = np.argsort(-sizes, kind="stable")  # words still walking stay a prefix
        flat = np.frombuffer(b"".join(words), np.uint8)
        begins = (np.cumsum(sizes) - sizes)[order]
        sizes = sizes[order]
        alive = np.arange(len(words))
        state = np.full(len(words), self.root, np.uint64)
        place = np.zeros(len(words), np.int64)
        for step in range(int(sizes[0]) + 1):
            ended = alive[sizes[alive] == step]
            hit = ended[self.final[state[ended]] == 1]
            out[order[hit]] = place[hit]
            alive = alive[sizes[alive] > step]
            if not len(alive):
                break
            key = state[alive] << np.uint64(8) | flat[begins[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            alive, at = alive[found], at[found]
            state[alive] = self.targets[at]
            place[alive] += self.adds[at]
        return out

    def ids_at(self, place: int) -> bytes:
        """Token ids of a place, as little-endian unsigned 32-bit."""
        return self.ids[self.starts[place]:self.starts[place + 1]].tobytes()
