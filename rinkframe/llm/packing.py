"""Bounded-space online packing of documents into token sequences.

Every input partition holds a fixed number of open windows. A piece goes to the
window it fits best; if it fits none and all windows are open, the fullest one is
topped up with the piece's head and emitted. Windows still open at the end of a
partition carry their tokens along and are packed again in groups of partitions,
level by level, until one small group is left; its last tokens are cut into
sequences of a power of two, which need no padding.

Defined cases: a null text is empty; every document ends with ``end_id``, so an
empty text is one token; repeated rows are packed each for itself; a text longer
than a window is cut into whole windows and a rest; an empty table gives no
pieces.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkframe.llm.bpe import Encoder
from rinkframe.llm.store import keep
from rinkframe.llm.words import lean, utf8

CAPACITY = 2048
OPEN_WINDOWS = 16
# A window with less room than this is emitted as it is: no piece is cut so short.
LEAST_CUT = 8
# So many partitions' leftovers are packed by one task at the next level.
FAN_IN = 64

PIECE = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
         "sequence_id bigint, offset bigint, ids binary, nest bigint, slot int, seat int")


class Packer:
    """Open windows of one task; emitted pieces are taken with ``drain``."""

    def __init__(self, nest: int, capacity: int, windows: int, with_ids: bool):
        self.nest, self.capacity, self.windows, self.with_ids = nest, capacity, windows, with_ids
        self.open: list[tuple[int, list]] = []
        self.sequences = 0
        self.out: list[tuple] = []

    def add(self, doc_id, start: int, ids: bytes, doc_tokens: int) -> None:
        whole = 4 * self.capacity
        while len(ids) >= whole:
            self._emit([(doc_id, start, ids[:whole], doc_tokens)])
            ids, start = ids[whole:], start + self.capacity
        while ids:
            n = len(ids) // 4
            fits = [(used, -k) for k, (used, _) in enumerate(self.open) if used + n <= self.capacity]
            if fits:
                self._put(-max(fits)[1], (doc_id, start, ids, doc_tokens))
                return
            if len(self.open) < self.windows:
                self.open.append((n, [(doc_id, start, ids, doc_tokens)]))
                return
            k = max(range(len(self.open)), key=lambda i: (self.open[i][0], -i))
            room = self.capacity - self.open[k][0]
            if room >= LEAST_CUT and n - room >= LEAST_CUT:
                self._put(k, (doc_id, start, ids[:4 * room], doc_tokens))
                ids, start = ids[4 * room:], start + room
            else:
                self._emit(self.open.pop(k)[1])

    def _put(self, k: int, piece: tuple) -> None:
        used, pieces = self.open[k]
        used += len(piece[2]) // 4
        pieces.append(piece)
        if used == self.capacity:
            self._emit(self.open.pop(k)[1])
        else:
            self.open[k] = (used, pieces)

    def _emit(self, pieces: list[tuple]) -> None:
        offset, sequence = 0, (self.nest << 32) + self.sequences
        self.sequences += 1
        for doc_id, start, ids, doc_tokens in pieces:
            n = len(ids) // 4
            self.out.append((doc_id, start, n, zlib.crc32(ids), doc_tokens, sequence, offset,
                             ids if self.with_ids else None, None, None, None))
            offset += n

    def finish(self) -> None:
        """Emit what is open without padding: whole windows, then powers of two."""
        pieces = [p for _, window in self.open for p in window]
        left = sum(len(p[2]) for p in pieces) // 4
        self.open, at, rest = [], 0, pieces[0][2] if pieces else b""
        cut = 0
        while left:
            size = min(self.capacity, 1 << (left.bit_length() - 1)) if left < self.capacity else self.capacity
            left, window = left - size, []
            while size:
                doc_id, start, _, doc_tokens = pieces[at]
                part = rest[:4 * size]
                window.append((doc_id, start + cut, part, doc_tokens))
                n = len(part) // 4
                size, cut, rest = size - n, cut + n, rest[4 * n:]
                if not rest:
                    at, cut = at + 1, 0
                    rest = pieces[at][2] if at < len(pieces) else b""
            self._emit(window)

    def leave(self) -> None:
        """Hand the open windows over to the next level, tokens included."""
        for slot, (_, window) in enumerate(self.open):
            for seat, (doc_id, start, ids, doc_tokens) in enumerate(window):
                self.out.append((doc_id, start, len(ids) // 4, None, doc_tokens, None, None,
                                 ids, self.nest, slot, seat))
        self.open = []

    def drain(self) -> pa.RecordBatch:
        names = [c.split()[0] for c in PIECE.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.binary(), pa.int64(), pa.int32(), pa.int32()]
        columns = list(zip(*self.out)) if self.out else [[]] * len(names)
        self.out = []
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def pack(df: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text",
         end_id: int = 1, capacity: int = CAPACITY, windows: int = OPEN_WINDOWS,
         with_ids: bool = True) -> DataFrame:
    """Pieces of all documents with their places in sequences.

    ``tokenizer`` is the path of a ``tokenizers`` file on every executor. One row per
    piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and,
    with ``with_ids``, ``ids`` (little-endian unsigned 32-bit). No text is shuffled;
    between levels only the tokens of open windows move, at most ``windows`` windows
    from each task.
    """
    def first(batches):
        coder = Encoder(tokenizer, None)
        packer = Packer(TaskContext.get().partitionId(), capacity, windows, with_ids)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            texts = list(utf8(batch.column(1)))
            for key, ids in zip(batch.column(0).to_pylist(), coder.ids(texts)):
                ids += end
                packer.add(key, 0, ids, len(ids) // 4)
                if len(packer.out) >= 5000:
                    yield packer.drain()
            yield packer.drain()
        packer.leave()
        yield packer.drain()

    def later(level: int, last: bool):
        def merge(table: pa.Table) -> pa.Table:
            table = table.sort_by([("nest", "ascending"), ("slot", "ascending"), ("seat", "ascending")])
            group = table.column("group")[0].as_py()
            packer = Packer((level << 25) + group, capacity, windows, with_ids)
            for row in table.select(["doc_id", "start", "ids", "doc_tokens"]).to_pylist():
                packer.add(row["doc_id"], row["start"], row["ids"], row["doc_tokens"])
            packer.finish() if last else packer.leave()
            return pa.Table.from_batches([packer.drain()])
        return merge

    source = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    done = keep(source.mapInArrow(lean(first), PIECE), "packed")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    names += ["ids"] * with_ids
    packed = [done.filter(F.col("sequence_id").isNotNull()).select(*names)]
    left, level = done.filter(F.col("sequence_id").isNull()), 1
    most = left.agg(F.max("nest")).first()[0]
    while most is not None:
        last = most < FAN_IN
        step = (left.withColumn("group", F.col("nest") % (1 << 25) / FAN_IN)
                .withColumn("group", F.floor("group").cast("bigint"))
                .groupBy("group").applyInArrow(later(level, last), PIECE))
        if last:
            packed.append(step.select(*names))
            break
        step = keep(step, f"packed-{level}")
        packed.append(step.filter(F.col("sequence_id").isNotNull()).select(*names))
        left = step.filter(F.col("sequence_id").isNull())
        most, level = (most // FAN_IN), level + 1
    out = packed[0]
    for more in packed[1:]:
        out = out.unionByName(more)
    return out
