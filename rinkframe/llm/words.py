"""Words and their hashes, for code that runs on Arrow batches inside tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

# Bytes that end a word: the six ASCII white-space characters, which are also
# what ``bytes.split()`` splits on.
SPACE = b" \t\n\v\f\r"

# Words are remembered up to this many per task, then forgotten: the bound of a
# task's memory, with no effect on results.
REMEMBERED = 250_000


def release(collect: bool = True) -> None:
    """Give free memory of this worker back to the system, by default after a collection
    of garbage, which takes tens of milliseconds."""
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(work: Callable) -> Callable:
    """``work`` on the batches of a task, without keeping memory when it is done.

    Python workers outlive their tasks. What a task remembered would stay with an idle
    worker, beside the workers of later stages.
    """
    def run(batches):
        yield from work(batches)
        release()
    return run


def utf8(texts: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of every text; a null is an empty text."""
    return (b if b is not None else b"" for b in _binary(texts).to_pylist())


def _binary(texts: pa.Array) -> pa.Array:
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    return texts.cast(pa.large_binary() if large else pa.binary())


class Remembered(dict):
    """Maps a word to what ``make(word)`` gives; forgets all when it is full."""

    def __init__(self, make, limit: int = REMEMBERED):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.make(word)
        return value


def word_hashes() -> Remembered:
    return Remembered(xxhash.xxh3_64_intdigest)


def hashed(words: list[bytes], table: Remembered) -> np.ndarray:
    return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    return np.random.Generator(np.random.PCG64(seed)).integers(
        0, 2**64, n, dtype=np.uint64) | np.uint64(1)


def window_hashes(values: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """One 64-bit hash per window of ``size`` consecutive values."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k, factor in enumerate(odd_numbers(size, seed)):
        out += values[k:k + n] * factor
    return mix(out)


def pack5(values: np.ndarray) -> bytes:
    """The lower 40 bits of each value, five bytes a piece."""
    return np.ascontiguousarray(
        values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpack5(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()
