"""Harmonic packing of tokenized documents into sequences of fixed capacity.

Lengths fall into reciprocal classes: class ``k`` has the lengths above
capacity/(k + 1) and up to capacity/k, and a bin of class ``k`` takes exactly
``k`` documents.  Each worker fills the bins of its own partition, class by
class, independently of all others: a scan and no shuffle at any size.

A bin of ``k`` documents has a gap below capacity/(k + 1) + k - 1.  Documents
may be cut freely, so gaps are filled rather than padded: once a worker's gaps
together hold ``slack`` sequences, the next document does not enter a bin but
is cut over them, the largest gaps first; one that fits the largest gap stays
whole.  A document longer than the capacity is cut into full sequences first
and its rest is treated as a document.

What a worker has left at its end (open bins and gaps, a bounded number) is
laid end to end into full sequences; the last tokens are cut at powers of two,
lengths that need no padding.

Edge cases: a null or empty text is one token (the end id); null ids stay
null; repeated rows are packed again; ties in length go by arrival; an empty
table gives no pieces; extra columns, whatever their names, are ignored; very
long texts are tokenized whole.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import tidy

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def split(piece: tuple, n: int) -> tuple[tuple, tuple]:
    """A piece (doc_id, start, length, ids, doc_tokens) cut behind its first n tokens."""
    doc, start, length, ids, total = piece
    return (doc, start, n, ids[: 4 * n], total), (doc, start + n, length - n, ids[4 * n :], total)


class Bins:
    """The bins of one worker."""

    def __init__(self, capacity: int, first_sequence: int, classes: int = 64, slack: int = 8):
        self.capacity, self.next, self.classes, self.slack = capacity, first_sequence, classes, slack
        self.open: dict[int, list[tuple]] = {}
        self.gaps: list[tuple[int, int]] = []  # heap of (-gap, bin)
        self.waiting: dict[int, list[tuple]] = {}
        self.room, self.bins, self.done = 0, 0, []

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for p in pieces:
            self.done.append((*p, self.next, at))
            at += p[2]
        self.next += 1

    def _wait(self, pieces: list[tuple], gap: int) -> None:
        """A bin whose class is complete: done if it is full, else it waits to be filled."""
        if not gap:
            self._close(pieces)
            return
        self.bins += 1
        self.waiting[self.bins] = pieces
        heapq.heappush(self.gaps, (-gap, self.bins))
        self.room += gap

    def _fill(self, piece: tuple) -> None:
        """Cut a piece over the largest gaps, which hold it."""
        while piece[2]:
            gap, number = heapq.heappop(self.gaps)
            pieces, n = self.waiting.pop(number), min(-gap, piece[2])
            head, piece = split(piece, n)
            self.room += gap
            self._wait([*pieces, head], -gap - n)

    def add(self, piece: tuple) -> None:
        while piece[2] >= self.capacity:
            head, piece = split(piece, self.capacity)
            self._close([head])
        size = piece[2]
        if not size:
            return
        if self.room >= max(size, self.slack * self.capacity):
            self._fill(piece)
            return
        k = min(self.classes, self.capacity // size)
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) == k:
            self.open[k] = []
            self._wait(held, self.capacity - sum(p[2] for p in held))

    def finish(self) -> None:
        """Lay the leftovers end to end; their last tokens are cut at powers of two."""
        left = [p for pieces in self.waiting.values() for p in pieces]
        left += [p for k in sorted(self.open) for p in self.open[k]]
        total = sum(p[2] for p in left)
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << b for b in range(self.capacity.bit_length() - 2, -1, -1) if (total % self.capacity) >> b & 1]
        self.open, self.gaps, self.waiting, self.room = {}, [], {}, 0
        left.reverse()
        for size in sizes:
            held, free = [], size
            while free:
                piece = left.pop()
                if piece[2] > free:
                    piece, rest = split(piece, free)
                    left.append(rest)
                held.append(piece)
                free -= piece[2]
            self._close(held)

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.done, strict=True)) or [()] * 7
        self.done = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, ARROW.types, strict=True)], schema=ARROW)


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` (a power of two) tokens.

    Columns: doc_id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens (with the end id), sequence_id, offset.  A sequence of fewer
    than ``capacity`` tokens has a power of two of them.
    """
    if capacity & (capacity - 1) or capacity < 1:
        raise ValueError("capacity must be a power of two")
    path = tokenizer_path or tokens.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(capacity, TaskContext.get().partitionId() << 40)
        encode = tokens.encoder(path).ids
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4", copy=False)
                bins.add((doc, 0, len(ids), ids.tobytes(), len(ids)))
                if len(bins.done) >= 2000:
                    yield bins.take()
        bins.finish()
        yield bins.take()

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(tidy(run), SCHEMA)
