"""Removal of repeated passages by a distributed, prefix-aware suffix sort.

A byte goes if a string of ``length`` bytes that covers it also starts in a
document with a smaller id.  Every string of that length is judged, exactly,
with a sorted array of sparse suffixes.

Documents with equal texts are found first, by digest: all but the smallest go
whole, and take no further part.  Then:

1.  *Suffixes.*  Each string is assigned to its anchor: the place inside it
    whose ``gram`` bytes have the smallest hash.  Equal strings have equal
    anchors, so only suffixes that start at anchors (about one byte in
    fourteen) take part, each with the range of strings that it stands for.
2.  *Duplicate detection.*  Batches of documents send the hashes of their
    anchors' first ``gram`` bytes to hash ranges and learn which ones other
    documents have.  Suffixes whose prefix is unique need no exchange.
3.  *Sorted runs.*  A batch sorts its other suffixes and settles what its own
    documents settle: of equal contexts only those of its smallest document
    are exchanged, all others are repeats.  So a passage that a third of all
    documents share is one entry of a batch.  Runs are front-coded: each
    suffix has the length of the prefix it shares with the one before it and
    its remaining bytes.  Equal prefixes go to equal merge ranges.
4.  *Merge.*  A range merges its runs with a loser tree whose entries keep
    their common prefix with the last winner: a longer common prefix wins
    without looking at a byte, and ties compare only bytes behind it.  The
    merged array has the common prefixes of neighbours; strings with the same
    bytes are runs of neighbours (to the right of the anchor) with equal bytes
    to its left, and the smallest document of each is kept.

Prefixes in more than ``hot_documents`` documents are exchanged string by
string, dealt by all their bytes, so that no prefix is one unbounded group.

Edge cases: null and empty texts, and texts shorter than ``length``, lose
nothing; a null id counts as larger than all ids; rows that share an id do not
count as smaller than each other; an empty table gives an empty result; texts
are processed whole and may be cut inside a character; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW_KEY, Scratch, let, release, tidy, with_row_key
from .minhash import mix64

NO_ID = np.int64(2**63 - 1)
_ODD = np.uint64(0xD1342543DE82EF95)
_BLOCK = 1 << 19
#: Texts with copies up to which their digests (40 bytes each) are broadcast.
BROADCAST_DIGESTS = 500_000


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _ODD)


def gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all strings of ``gram`` bytes: polynomial hashes of doubling widths, joined by the binary digits of ``gram``."""
    n = len(x) - gram + 1
    h, power, width, out, size = _BYTE[x], np.array([_ODD]), 1, None, 0
    while True:
        if gram & width:
            part = h[size : size + n]
            out = part.copy() if out is None else out * power + part
            size += width
        if size == gram:
            return mix64(out)
        h = h[:-width] * power + h[width:]
        power, width = power * power, width * 2


class Anchors:
    """Anchored suffixes of a batch: place, hash of the prefix, first and last string start they stand for, document."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, length: int, gram: int):
        place, first, last, hashes = [], [], [], []
        span = length - gram + 1
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64) if len(ends) else np.empty(0, np.int64)
        for s in range(0, max(0, len(data) - length + 1), _BLOCK):
            x = data[s : s + _BLOCK + length - 1]
            n = len(x) - length + 1
            h = gram_hashes(x, gram)
            m = (h & ~np.uint64(0xFFFFF)) | np.arange(len(h), dtype=np.uint64)
            width = 1
            while width * 2 <= span:
                m = np.minimum(m[:-width], m[width:])
                width *= 2
            if width < span:
                m = np.minimum(m[: n], m[span - width : span - width + n])
            at = (m[:n] & np.uint64(0xFFFFF)).astype(np.int64)
            # strings that end inside their document
            d0 = int(np.searchsorted(ends, s, side="right"))
            ok = np.ones(n, dtype=bool)
            for e in ends[d0 : int(np.searchsorted(ends, s + n + length, side="right")) + 1]:
                ok[max(0, int(e) - length + 1 - s) : max(0, int(e) - s)] = False
            idx = np.flatnonzero(ok)
            if not len(idx):
                continue
            p = at[idx]
            new = np.concatenate(([True], p[1:] != p[:-1]))
            begin = np.flatnonzero(new)
            place.append(p[begin] + s)
            hashes.append(h[p[begin]])
            first.append(idx[begin] + s)
            last.append(idx[np.concatenate((begin[1:], [len(idx)])) - 1] + s)
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
        self.place, self.first, self.last = join(place, np.int64), join(first, np.int64), join(last, np.int64)
        self.hash, self.starts = join(hashes, np.uint64), starts
        self.doc = np.searchsorted(ends, self.place, side="right")


def _slot(h: np.ndarray, ranges: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _low(h: np.ndarray) -> np.ndarray:
    """32 bits of the hash that do not decide its range; a clash costs an exchange, never a wrong result."""
    return (mix64(h) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


class _Distinct:
    """Distinct (range, low hash) of a batch's anchors, sorted; ``inverse`` leads from anchors to them."""

    def __init__(self, anchors: Anchors, ranges: int):
        keys = (_slot(anchors.hash, ranges).astype(np.uint64) << np.uint64(32)) | _low(anchors.hash)
        self.keys, self.inverse = np.unique(keys, return_inverse=True)
        self.cuts = np.searchsorted(self.keys, np.arange(ranges + 1, dtype=np.uint64) << np.uint64(32))

    def documents(self, doc: np.ndarray) -> np.ndarray:
        """Number of documents of the batch that have each key, up to 65535."""
        if not len(doc):
            return np.empty(0, np.uint16)
        pairs = np.unique(self.inverse.astype(np.int64) * (int(doc.max()) + 1) + doc) // (int(doc.max()) + 1)
        return np.minimum(np.bincount(pairs, minlength=len(self.keys)), 65535).astype(np.uint16)


def pack_header(ids: list, texts: list[bytes], whole: list[int], keys: list[tuple[int, int]]) -> bytes:
    """Per document: id, whether there is one, bytes in the batch's body, bytes of the document if it goes whole (else -1), row key (two numbers)."""
    numbers = (
        np.array([NO_ID if i is None else i for i in ids], np.int64),
        np.array([i is not None for i in ids], np.int64),
        np.array([len(t) for t in texts], np.int64),
        np.array(whole, np.int64),
        np.array(keys, np.int64).reshape(-1, 2),
    )
    return np.column_stack(numbers).tobytes()


def _pack_spans(spans: np.ndarray) -> bytes:
    """(document, start, end) rows in order, as differences, compressed."""
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    out = np.column_stack((np.diff(spans[:, 0], prepend=0), np.diff(spans[:, 1], prepend=0), spans[:, 2] - spans[:, 1]))
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(out.T).tobytes())


def _unpack_spans(blob: bytes) -> np.ndarray:
    doc, start, size = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.int64).reshape(3, -1)
    start = np.cumsum(start)
    return np.column_stack((np.cumsum(doc), start, start + size))


def _unpack(header, body) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The header's rows, ends of texts, all bytes."""
    head = np.frombuffer(header.as_buffer(), np.int64).reshape(-1, 6)
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(body.as_py()), np.uint8)
    return head, np.cumsum(head[:, 2]), data


ROWS = pa.schema([("kind", pa.int32()), ("batch", pa.int64()), ("range", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])
ROWS_DDL = "kind int, batch long, range int, a binary, b binary"


def _record(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(ROWS)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ROWS, strict=True)], schema=ROWS)


def _batches(docs: DataFrame, length: int, gram: int, ranges: int, batch_bytes: int) -> DataFrame:
    """Rows of kind 0: distinct prefix hashes of a batch in a range; kind 1: the batch's documents."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        packer = zstandard.ZstdCompressor(level=3)

        def flush(ids: list, texts: list[bytes], whole: list[int], places: list[tuple[int, int]]) -> pa.RecordBatch:
            body = b"".join(texts)
            anchors = Anchors(np.frombuffer(body, np.uint8), np.cumsum([len(t) for t in texts]), length, gram)
            keys = _Distinct(anchors, ranges)
            many, low = keys.documents(anchors.doc), keys.keys.astype(np.uint32)
            rows = [(0, number, r, low[x:y].tobytes(), many[x:y].tobytes()) for r, (x, y) in enumerate(zip(keys.cuts[:-1], keys.cuts[1:], strict=True)) if x < y]
            rows.append((1, number, -1, pack_header(ids, texts, whole, places), packer.compress(body)))
            return _record(rows)

        ids, texts, whole, places, held = [], [], [], [], 0
        for batch in incoming:
            for doc, text, copy, *place in zip(batch.column(0).to_pylist(), batch.column(1), *(batch.column(j).to_pylist() for j in (2, 3, 4)), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                gone = copy and len(raw) >= length
                ids.append(doc)
                texts.append(b"" if gone else raw)
                whole.append(len(raw) if gone else -1)
                places.append(tuple(place))
                held += len(texts[-1]) + 64
                if held >= batch_bytes:
                    yield flush(ids, texts, whole, places)
                    ids, texts, whole, places, held, number = [], [], [], [], 0, number + 1
        if ids:
            yield flush(ids, texts, whole, places)

    return docs.mapInArrow(tidy(run), ROWS_DDL)


REPLY = pa.schema([("batch", pa.int64()), ("range", pa.int32()), ("marks", pa.binary()), ("shared", pa.int64())])


def _detect(hot_documents: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Marks of a range for each of its batches: 0 in one document, 1 in several, 2 in very many."""
        low = [np.frombuffer(x.as_buffer(), np.uint32) for x in table["a"]]
        many = [np.frombuffer(x.as_buffer(), np.uint16) for x in table["b"]]
        _, inverse = np.unique(np.concatenate(low), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate(many).astype(np.float64))
        mark = ((total > 1).astype(np.uint8) + (total > hot_documents).astype(np.uint8))[inverse]
        parts = np.split(mark, np.cumsum([len(x) for x in low])[:-1])
        packer = zstandard.ZstdCompressor(level=1)
        return pa.table([table["batch"], table["range"], pa.array([packer.compress(p.tobytes()) for p in parts], pa.binary()), pa.array([int((p > 0).sum()) for p in parts], pa.int64())], schema=REPLY)

    return run


class Entries:
    """Suffixes with context, as arrays: right bytes (padded), left bytes (from the anchor outwards), offsets, ids and places."""

    FIELDS = {"low": np.uint8, "high": np.uint8, "id": np.int64, "doc": np.int32, "place": np.int64}

    def __init__(self, right: np.ndarray, left: np.ndarray, **columns: np.ndarray):
        self.right, self.left = right, left
        for name, kind in self.FIELDS.items():
            setattr(self, name, columns[name].astype(kind, copy=False))

    def take(self, index: np.ndarray) -> Entries:
        return Entries(self.right[index], self.left[index], **{k: getattr(self, k)[index] for k in self.FIELDS})

    @classmethod
    def of(cls, data: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray, ids: np.ndarray, doc: np.ndarray, length: int, gram: int) -> Entries:
        right_n, left_n = last + length - place, place - first
        padded = np.concatenate((np.zeros(length - gram, np.uint8), data, np.zeros(length, np.uint8)))
        base = place + (length - gram)
        right = padded[base[:, None] + np.arange(length)[None, :]]
        right[np.arange(length)[None, :] >= right_n[:, None]] = 0
        left = padded[base[:, None] - 1 - np.arange(length - gram)[None, :]] if length > gram else np.zeros((len(place), 0), np.uint8)
        left[np.arange(length - gram)[None, :] >= left_n[:, None]] = 0
        return cls(right, left, low=place - last, high=left_n, id=ids, doc=doc, place=place)

    def order(self) -> np.ndarray:
        """Sorted order of the right bytes."""
        n, width = self.right.shape
        words = -(-width // 8)
        full = np.zeros((n, words * 8), np.uint8)
        full[:, :width] = self.right
        keys = full.view(">u8").astype(np.uint64)
        return np.lexsort(tuple(keys[:, k] for k in range(words - 1, -1, -1)))

    def common(self) -> np.ndarray:
        """Common prefix of each right part with the one before it (0 for the first)."""
        out = np.zeros(len(self.right), np.int64)
        if len(out) > 1:
            differ = self.right[1:] != self.right[:-1]
            any_differ = differ.any(1)
            out[1:] = np.where(any_differ, differ.argmax(1), self.right.shape[1])
        return out


def encode_run(e: Entries) -> bytes:
    """A sorted run, front-coded: common prefix lengths, then the bytes behind them."""
    lcp = e.common()
    tail = e.right[np.arange(e.right.shape[1])[None, :] >= lcp[:, None]]
    left_n = e.high.astype(np.int64)
    left = e.left[np.arange(e.left.shape[1])[None, :] < left_n[:, None]]
    parts = [np.array([len(lcp), e.right.shape[1], e.left.shape[1]], np.int64), lcp.astype(np.uint8), tail, left, *(getattr(e, k) for k in e.FIELDS)]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(p.tobytes() for p in parts))


def decode_run(blob: bytes) -> tuple[Entries, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, width, left_width = np.frombuffer(raw, np.int64, 3).tolist()
    at = 24

    def read(kind, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, kind, count, at)
        at += out.nbytes
        return out

    lcp = read(np.uint8, n).astype(np.int64)
    inside = np.arange(width)[None, :] >= lcp[:, None]
    right = np.zeros((n, width), np.uint8)
    right[inside] = read(np.uint8, int(inside.sum()))
    # bytes before the common prefix come from the nearest earlier suffix that spells them out
    for c in range(width):
        spelled = np.maximum.accumulate(np.where(inside[:, c], np.arange(n), 0))
        right[:, c] = right[spelled, c]
    rest = len(raw) - at - n * sum(np.dtype(k).itemsize for k in Entries.FIELDS.values())
    left_bytes = read(np.uint8, rest)
    columns = {k: read(t, n) for k, t in Entries.FIELDS.items()}
    left = np.zeros((n, left_width), np.uint8)
    left[np.arange(left_width)[None, :] < columns["high"].astype(np.int64)[:, None]] = left_bytes
    return Entries(right, left, **columns), lcp


def merge_runs(runs: list[list[bytes]], lcps: list[list[int]]) -> tuple[list[int], list[int], list[int]]:
    """Merge sorted runs of equally long strings with a loser tree that knows common prefixes.

    ``lcps[r][i]`` is the common prefix of string i of run r with string
    i - 1.  Returns run, index and common prefix with the string before, for
    every string in sorted order.  A contestant carries its common prefix with
    the last winner: of two, the one with the longer prefix is smaller, and
    only equal prefixes are compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads = [0] * k
    sizes = [len(r) for r in runs] + [0] * (k - len(runs))
    known = [0] * k  # common prefix of a run's head with the last winner
    alive = [s > 0 for s in sizes]

    def beats(a: int, b: int) -> bool:
        """Whether the head of run a is before that of b; the loser learns its common prefix with the winner."""
        if not alive[b]:
            return True
        if not alive[a]:
            return False
        x, y = known[a], known[b]
        if x != y:
            return x > y
        s, t = runs[a][heads[a]][x:], runs[b][heads[b]][x:]
        if s == t:
            common, first = x + len(s), a < b
        else:
            common = x + len(s) - ((int.from_bytes(s) ^ int.from_bytes(t)).bit_length() + 7) // 8
            first = s < t
        known[b if first else a] = common
        return first

    losers = [0] * k

    def play(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        if beats(a, b):
            losers[node] = b
            return a
        losers[node] = a
        return b

    winner = play(1) if k > 1 else 0
    out_run, out_index, out_lcp = [], [], []
    while alive[winner]:
        i = heads[winner]
        out_run.append(winner)
        out_index.append(i)
        out_lcp.append(known[winner])
        i += 1
        heads[winner] = i
        if i < sizes[winner]:
            known[winner] = lcps[winner][i]
        else:
            alive[winner] = False
        node = (winner + k) >> 1
        while node:
            other = losers[node]
            if alive[other]:
                x, y = (known[winner], known[other]) if alive[winner] else (-1, 0)
                if x < y or (x == y and not beats(winner, other)):
                    losers[node], winner = winner, other
            node >>= 1
    return out_run, out_index, out_lcp


def repeats(e: Entries, lcp: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(smallest, largest) offset of the strings of each entry that a smaller document has; (1, 0) if none.

    ``e`` is sorted by its right bytes and ``lcp`` has their common prefixes.
    """
    n, span = len(lcp), length - gram
    least, most = np.full(n, 1, np.int64), np.zeros(n, np.int64)
    found = np.zeros(n, dtype=bool)
    left_hash = np.zeros(n, np.uint64)
    for o in range(span + 1):
        if o:
            left_hash = mix64(left_hash * _ODD + e.left[:, o - 1].astype(np.uint64) + np.uint64(1))
        has = np.flatnonzero((e.low <= o) & (o <= e.high))
        if len(has) < 2:
            continue
        group = np.cumsum(lcp < length - o)[has].astype(np.uint64)
        key = mix64(group * _ODD + left_hash[has])
        order = np.argsort(key, kind="stable")
        key, group, rows = key[order], group[order], has[order]
        same = np.concatenate(([False], key[1:] == key[:-1]))
        wrong = same[1:] & ((group[1:] != group[:-1]) | (e.left[rows[1:], :o] != e.left[rows[:-1], :o]).any(1))
        if wrong.any():  # two strings with one hash: order by the bytes themselves
            order = np.lexsort((*(e.left[has, j] for j in range(o)), np.cumsum(lcp < length - o)[has]))
            rows = has[order]
            group = np.cumsum(lcp < length - o)[rows]
            same = np.concatenate(([False], (group[1:] == group[:-1]) & (e.left[rows[1:], :o] == e.left[rows[:-1], :o]).all(1)))
        begin = np.flatnonzero(~same)
        smallest = np.minimum.reduceat(e.id[rows], begin)[np.cumsum(~same) - 1]
        hit = rows[e.id[rows] > smallest]
        least[hit] = np.where(found[hit], least[hit], o)
        most[hit] = o
        found[hit] = True
    return least, most


def _equal_contexts(e: Entries) -> np.ndarray:
    """Number of the group of entries with equal bytes on both sides and equal offsets."""
    key = np.full(len(e.id), np.uint64(7))
    sides = np.column_stack((e.right, e.left, e.low, e.high))
    pad = (-sides.shape[1]) % 8
    wide = np.ascontiguousarray(np.column_stack((sides, np.zeros((len(sides), pad), np.uint8)))).view(np.uint64)
    for j in range(wide.shape[1]):
        key = mix64(key * _ODD + wide[:, j])
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], (wide[order[1:]] != wide[order[:-1]]).any(1)))
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _runs(length: int, gram: int, ranges: int, merge_ranges: int):
    """Rows of kind 2: sorted runs by merge range; kind 3: repeats that the batch itself settles (document, start, end)."""

    def run(key: tuple, batch: pa.Table, replies: pa.Table) -> pa.Table:
        rows, number = [], key[0].as_py()
        for header, body in zip(batch["a"], batch["b"], strict=True):
            head, ends, data = _unpack(header, body)
            ids = head[:, 0]
            anchors = Anchors(data, ends, length, gram)
            keys = _Distinct(anchors, ranges)
            order, blobs, unpack = np.argsort(replies["range"].to_numpy()), replies["marks"].to_pylist(), zstandard.ZstdDecompressor()
            marks = np.frombuffer(b"".join(unpack.decompress(blobs[i]) for i in order), np.uint8)[keys.inverse]
            local: list[np.ndarray] = []
            by_range: dict[int, list[Entries]] = {}
            for hot in (False, True):
                chosen = np.flatnonzero(marks == 1 + hot)
                if not len(chosen):
                    continue
                place, first, last, doc = anchors.place[chosen], anchors.first[chosen], anchors.last[chosen], anchors.doc[chosen]
                dealt = mix64(anchors.hash[chosen])
                if hot:  # one entry per string, dealt by all its bytes
                    count = last - first + 1
                    start = np.repeat(first, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                    place, first, last, doc = start, start, start, np.repeat(doc, count)
                for x in range(0, len(place), 50_000):
                    part = slice(x, x + 50_000)
                    if hot:
                        dealt_part = gram_hashes_at(data, place[part], length)
                    else:
                        dealt_part = dealt[part]
                    e = Entries.of(data, place[part], first[part], last[part], ids[doc[part]], doc[part], length, gram)
                    slot = _slot(dealt_part, merge_ranges)
                    by = np.argsort(slot, kind="stable")
                    cuts = np.flatnonzero(np.concatenate(([True], np.diff(slot[by]) > 0, [True])))
                    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                        by_range.setdefault(int(slot[by[a]]), []).append(e.take(by[a:b]))
            for slot, parts in by_range.items():
                e = Entries(np.concatenate([p.right for p in parts]), np.concatenate([p.left for p in parts]), **{k: np.concatenate([getattr(p, k) for p in parts]) for k in Entries.FIELDS})
                group = _equal_contexts(e)
                smallest = np.full(int(group.max()) + 1, NO_ID)
                np.minimum.at(smallest, group, e.id)
                later = e.id > smallest[group]
                if later.any():
                    local.append(np.column_stack((e.doc[later].astype(np.int64), e.place[later] - e.high[later], e.place[later] - e.low[later] + length)))
                e = e.take(np.flatnonzero(~later))
                rows.append((2, number, slot, encode_run(e.take(e.order())), b""))
            if local:
                rows.append((3, number, -1, _pack_spans(np.concatenate(local).astype(np.int64)), b""))
        columns = list(zip(*rows, strict=True)) or [()] * len(ROWS)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, ROWS, strict=True)], schema=ROWS)

    return run


def gram_hashes_at(data: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the strings of ``length`` bytes at the given places."""
    h = np.zeros(len(place), np.uint64)
    for j in range(length):
        h = mix64(h * _ODD + data[place + j].astype(np.uint64) + np.uint64(1))
    return h


def _merge(length: int, gram: int):
    """Rows of kind 4: repeats of a batch that other batches settle."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        decoded = [decode_run(x.as_py()) for x in table["a"]]
        strings = [[row.tobytes() for row in e.right] for e, _ in decoded]
        of_run, index, lcp = merge_runs(strings, [x.tolist() for _, x in decoded])
        del strings
        first = np.concatenate(([0], np.cumsum([len(e.id) for e, _ in decoded])))
        order = first[np.array(of_run, dtype=np.int64)] + np.array(index, dtype=np.int64) if of_run else np.empty(0, np.int64)
        e = Entries(np.concatenate([d.right for d, _ in decoded]), np.concatenate([d.left for d, _ in decoded]), **{k: np.concatenate([getattr(d, k) for d, _ in decoded]) for k in Entries.FIELDS}).take(order)
        least, most = repeats(e, np.array(lcp, dtype=np.int64), length, gram)
        hit = np.flatnonzero(least <= most)
        spans = np.column_stack((e.doc[hit].astype(np.int64), e.place[hit] - most[hit], e.place[hit] - least[hit] + length))
        owner = np.array(of_run, dtype=np.int64)[hit]
        numbers = table["batch"].to_pylist()
        rows = [(4, numbers[r], -1, _pack_spans(spans[owner == r]), b"") for r in np.unique(owner).tolist()]
        del decoded, e, spans, table
        release()
        columns = list(zip(*rows, strict=True)) or [()] * len(ROWS)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, ROWS, strict=True)], schema=ROWS)

    return run


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()), (ROW_KEY[0], pa.int64()), (ROW_KEY[1], pa.int64())])


RESULT_DDL = f"doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary, {ROW_KEY[0]} long, {ROW_KEY[1]} long"


def _finish(key: tuple, batch: pa.Table, found: pa.Table) -> pa.Table:
    """Removed spans (maximal) and remaining bytes of a batch's documents."""
    out: list[list] = [[] for _ in RESULT]
    for header, body in zip(batch["a"], batch["b"], strict=True):
        head, ends, data = _unpack(header, body)
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        spans = np.concatenate([_unpack_spans(x.as_py()) for x in found["a"]] or [np.empty((0, 3), np.int64)])
        spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
        edges = np.searchsorted(spans[:, 0], np.arange(len(head) + 1))
        out[4].extend(head[:, 4].tolist())
        out[5].extend(head[:, 5].tolist())
        for d, ((i, k, _, whole, *_), s, e) in enumerate(zip(head.tolist(), starts.tolist(), ends.tolist(), strict=True)):
            if whole >= 0:
                out[0].append(i if k else None)
                out[1].append(whole)
                out[2].append([{"start": 0, "end": whole}])
                out[3].append(b"")
                continue
            merged: list[list[int]] = []
            for _, a, b in spans[edges[d] : edges[d + 1]].tolist():
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            at, pieces = s, []
            for a, b in merged:
                pieces.append(data[at:a].tobytes())
                at = b
            pieces.append(data[at:e].tobytes())
            out[0].append(i if k else None)
            out[1].append(e - s)
            out[2].append([{"start": a - s, "end": b - s} for a, b in merged])
            out[3].append(b"".join(pieces))
    table = pa.table([pa.array(c, f.type) for c, f in zip(out, RESULT, strict=True)], schema=RESULT)
    del out, found, batch
    release()
    return table


def _marked_copies(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text, copy, row key): whether a document with a smaller id has the same text.

    The table of texts that occur more than once (digest and smallest id) is
    broadcast while it is small; beyond, the join shuffles.
    """
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    again = docs.select(digest.alias("digest"), "doc_id").groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    again = scratch.put(again.where("n > 1 and least is not null").select(F.col("digest").alias("__digest"), "least"), "copies")
    if again.count() <= BROADCAST_DIGESTS:
        again = F.broadcast(again)
    copy = F.col("least").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("least")))
    return docs.join(again, digest == F.col("__digest"), "left").select("doc_id", "text", copy.alias("copy"), *ROW_KEY)


def remove_repeats(docs: DataFrame, length: int = 50, gram: int = 24, id_col: str = "doc_id", text_col: str = "text", hot_documents: int = 8192, docs_per_range: int = 4000, batch_bytes: int = 4 << 20, merge_entries: int = 100_000) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (removed, maximal, in bytes), kept (remaining bytes) and the row key of ``docs`` (zero without one)."""
    scratch = Scratch(docs.sparkSession, "suffix")
    key = [F.col(c) if c in docs.columns else F.lit(0).cast("long").alias(c) for c in ROW_KEY]
    docs = docs.select(*key, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ranges = max(8, math.ceil(docs.count() / docs_per_range))
    _batches(_marked_copies(docs, scratch), length, gram, ranges, batch_bytes).write.partitionBy("kind").option("compression", "uncompressed").parquet(scratch.path("batches"))
    columns = "batch long, range int, a binary, b binary"
    reader = docs.sparkSession.read.schema(columns)
    spark = docs.sparkSession

    def kind(table: str, number: int) -> DataFrame:
        path = scratch.path(f"{table}/kind={number}")
        there = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
            return spark.createDataFrame([], columns)
        return reader.parquet(path)

    replies = kind("batches", 0).groupBy("range").applyInArrow(_detect(hot_documents), "batch long, range int, marks binary, shared long")
    replies = scratch.put(replies, "replies")
    scratch.drop("batches/kind=0")
    shared = replies.agg(F.sum("shared")).first()[0] or 0
    texts = kind("batches", 1).select("batch", "a", "b")
    runs = texts.groupBy("batch").cogroup(replies.select("batch", "range", "marks").groupBy("batch")).applyInArrow(_runs(length, gram, ranges, max(1, math.ceil(shared / merge_entries))), ROWS_DDL)
    runs.write.partitionBy("kind").option("compression", "uncompressed").parquet(scratch.path("runs"))
    merged = kind("runs", 2).groupBy("range").applyInArrow(_merge(length, gram), ROWS_DDL)
    merged = scratch.put(merged, "merged")
    scratch.drop("runs/kind=2")
    found = kind("runs", 3).select("batch", "a").unionByName(merged.select("batch", "a"))
    return texts.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(_finish, RESULT_DDL)


def _cut(text: Column, spans: Column) -> Column:
    """``text`` without the bytes of ``spans``, and without what is left of characters that a span's edge splits."""

    def body(raw: Column) -> Column:
        inside = lambda i: F.substr(raw, (i + 1).cast("int"), F.lit(1)).between(F.unhex(F.lit("80")), F.unhex(F.lit("BF")))
        after = lambda i: i + F.when(~inside(i), 0).when(~inside(i + 1), 1).when(~inside(i + 2), 2).otherwise(3)
        before = lambda i: i - F.when(~inside(i), 0).when(~inside(i - 1), 1).when(~inside(i - 2), 2).otherwise(3)
        starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda x: after(x["end"])))
        ends = F.concat(F.transform(spans, lambda x: before(x["start"])), F.array(F.length(raw).cast("long")))
        piece = lambda a, z: F.substr(raw, (a + 1).cast("int"), F.greatest(z - a, F.lit(0)).cast("int")).cast("string")
        return F.array_join(F.zip_with(starts, ends, piece), "")

    return let(text.cast("binary"), body)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` with repeated passages cut out of the text (bytes of a split character go too) and ``n_chars`` renewed.

    Documents that lost a passage and of which nothing is left go; all other
    rows stay, as often as they are there and with or without an id or text.
    Rows are told apart by where they are stored; columns of any other name
    come back untouched.
    """
    keyed = with_row_key(docs, Scratch(docs.sparkSession, "suffix-rows"))
    found = remove_repeats(keyed, id_col=id_col, text_col=text_col, **params).where(F.size("spans") > 0)
    cuts = Scratch(docs.sparkSession, "suffix-spans").put(found.select(*ROW_KEY, F.col("spans").alias("__spans")), "spans")
    out = keyed.join(cuts, list(ROW_KEY), "left")
    cut, text = F.col("__spans").isNotNull(), F.col(text_col).cast("string")
    out = out.withColumn(text_col, F.when(cut, _cut(text, F.col("__spans"))).otherwise(text)).where(~cut | (F.length(text_col) > 0))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
