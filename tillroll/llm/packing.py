"""Packing into windows by best fit decreasing (operator 8).

Each Spark partition is tokenized and packed where it is read: nothing is
shuffled, a lost task is repeated with the same result, and a task holds only
the ids of its own short pieces.  Documents longer than a window are first cut
into full windows.  The rest are placed longest first; a segment tree indexed by
remaining capacity finds the tightest window that still has room.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .bpe import crc, default_vocabulary, vocabulary
from .common import slices

COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class OpenWindows:
    """Open windows by remaining capacity, with a segment tree over the capacities."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, n: int) -> None:
        i = room + self.leaves
        while i:
            self.count[i] += n
            i >>= 1

    def put(self, window: int, room: int) -> None:
        if room:
            self.at[room].append(window)
            self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least remaining capacity of at least ``need``, and that capacity."""
        i = need + self.leaves
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):   # up to a right sibling that holds a window
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.leaves
        self._add(room, -1)
        return self.at[room].pop(), room


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Windows as lists of item numbers; equal lengths keep their order."""
    tree = OpenWindows(capacity)
    windows: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        got = tree.take(lengths[i])
        if got is None:
            windows.append([i])
            tree.put(len(windows) - 1, capacity - lengths[i])
        else:
            windows[got[0]].append(i)
            tree.put(got[0], got[1] - lengths[i])
    return windows


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
         end_id: int = 2, slack: float = 0.05, vocab_path: str | None = None) -> DataFrame:
    """Pack every text's token ids, each text closed by ``end_id``, into sequences of ``capacity``.

    One row per piece: doc_id, start (the document's ids before it), length,
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers), doc_tokens,
    sequence_id, offset.  Every id lies in exactly one piece; offsets have no gaps.
    A document of more than ``capacity`` ids first gives full sequences of its own.
    A window left with more than ``slack`` of its capacity empty is cut into
    sequences whose lengths are powers of two, which need no padding.

    Null text is read as empty and packs its end id alone.  Null, equal ids and
    repeated rows are packed one by one.  An empty table gives no rows; other
    columns are ignored.  sequence_id is unique over the whole result: the
    partition's number in the upper bits, the window's in the lower 40.
    """
    path = vocab_path or default_vocabulary()

    def run(batches):
        base = TaskContext.get().partitionId() << 40
        bpe, end = vocabulary(path), np.array([end_id], "<u4").tobytes()
        used = 0
        rests: list[tuple] = []                  # (doc, start, ids in two bytes or four, doc_tokens)
        kind = None

        def rows(pieces):
            cols = list(zip(*pieces))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], kind), *(pa.array(c, pa.int64()) for c in cols[1:])], names=list(COLUMNS))

        small = "<u2" if max(bpe.names) < 65536 and end_id < 65536 else "<u4"
        for batch in batches:
            kind = batch.schema.field("id").type
            for part in slices(batch, "text"):
                full = []
                coded = bpe.encode([t or "" for t in part.column("text").to_pylist()])
                for doc, ids in zip(part.column("id").to_pylist(), coded):
                    ids += end
                    total = len(ids) // 4
                    start = 0
                    while total - start >= capacity:
                        piece = ids[4 * start:4 * (start + capacity)]
                        full.append((doc, start, capacity, crc(piece), total, base + used, 0))
                        used += 1
                        start += capacity
                    if start < total:
                        rests.append((doc, start, np.frombuffer(ids, "<u4")[start:].astype(small), total))
                if full:
                    yield rows(full)
        done = []
        for window in best_fit_decreasing([len(r[2]) for r in rests], capacity):
            filled = sum(len(rests[i][2]) for i in window)
            if capacity - filled > slack * capacity:
                rooms = [1 << b for b in reversed(range(filled.bit_length())) if filled >> b & 1]
            else:
                rooms = [capacity]
            offset = 0
            for i in window:
                doc, start, ids, total = rests[i]
                at = 0
                while at < len(ids):
                    if offset == rooms[0]:
                        rooms, offset, used = rooms[1:], 0, used + 1
                    n = min(len(ids) - at, rooms[0] - offset)
                    done.append((doc, start + at, n, crc(ids[at:at + n].astype("<u4").tobytes()), total,
                                 base + used, offset))
                    at, offset = at + n, offset + n
            used += 1
            if len(done) >= 20_000:
                yield rows(done)
                done = []
        if done:
            yield rows(done)

    src = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COLUMNS[1:]))
