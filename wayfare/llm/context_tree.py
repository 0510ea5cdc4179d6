"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; each decision node has a tree of contexts,
the 0 to ``depth`` bytes before it (4 by default).  Every node of that tree
holds a Krichevsky-Trofimov (KT) estimate of its decisions; from the deepest
contexts up, a node's weighted probability is half its own estimate and half
the product of its children's.  Predictions are the exact conditional
probabilities of that mixture after all training text, so all depths count
with their posterior weights; their negative logarithms are code lengths.  A
text ends with a zero byte and starts after zero bytes.

Each batch of documents hands its distinct (context, byte) strings with their
training counts to hash ranges, which add them up.  Strings with the same two
last context bytes meet in one range of contexts, where the trees below depth
2 are computed; what lies above is built on the driver from byte triples (at
most 65,793 contexts of 256 nodes, whatever the corpus) and broadcast.  Hash
ranges then send every batch the probabilities of its strings.

The base score is a smoothed unigram model of words, for comparison.  Each
task hands the distinct word hashes of a batch of documents with their
training counts to hash ranges, which add them up and send each batch the
totals of its words: an exchange of distinct words per batch, so that a word
that is in every document is one entry of a batch.  Words are told apart by
64-bit hashes.

Edge cases: null and empty texts have the end alone; null ids count as the
empty text for the split; repeated rows train and are scored again; an empty
table gives an empty result; without training documents all estimates are
uniform; texts are read whole; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .minhash import WordHashes, mix64

END_WORD = np.uint64(0x9E3779B97F4A7C15)
COUNT_RANGES = 64


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive numbers: recurrence up to 8, then Stirling's series."""
    x = np.asarray(x, dtype=np.float64).copy()
    shift = np.zeros_like(x)
    for _ in range(8):
        low = x < 8
        if not low.any():
            break
        shift[low] += np.log(x[low])
        x[low] += 1
    inv = 1 / x
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + inv / 12 - inv**3 / 360 + inv**5 / 1260 - shift


def _decisions(rows: np.ndarray) -> np.ndarray:
    """Next-byte counts (n, 256) -> totals of the decision tree (n, 512): node i has children 2i and 2i + 1."""
    out = np.zeros((len(rows), 512))
    out[:, 256:] = rows
    for i in range(255, 0, -1):
        out[:, i] = out[:, 2 * i] + out[:, 2 * i + 1]
    return out


def _block(t: np.ndarray) -> np.ndarray:
    """KT log probability of the decisions counted in a tree, per node (n, 256)."""
    zero, one = t[:, 0::2], t[:, 1::2]
    return log_gamma(zero + 0.5) + log_gamma(one + 0.5) - log_gamma(zero + one + 1) - math.log(math.pi)


def _next(t: np.ndarray) -> np.ndarray:
    """KT probability that the next decision is 1, per node (n, 256)."""
    zero, one = t[:, 0::2], t[:, 1::2]
    return (one + 0.5) / (zero + one + 1.0)


HALF = math.log(0.5)


class Top:
    """The tree down to contexts of two bytes, mixed with what lies below.

    The probability of a 1 at node i after bytes a, b is ``base[row, i] +
    share[row, i] * p`` for the row ``row_of[b * 256 + a]``, where p is the
    prediction of the trees below.  Contexts that training never had share a
    row per last byte.
    """

    def __init__(self, row_of: np.ndarray, base: np.ndarray, share: np.ndarray):
        self.row_of, self.base, self.share = row_of, base, share

    @classmethod
    def build(cls, codes: np.ndarray, counts: np.ndarray, keys: np.ndarray, below: np.ndarray) -> Top:
        """From counts of byte triples (a * 65536 + b * 256 + next, a before b) and the weighted log probabilities of the
        trees below, summed per key (b * 256 + a) * 256 + node."""
        codes = codes.astype(np.int64)
        swapped = ((codes >> 8 & 255) << 8) | (codes >> 16)
        contexts, inverse = np.unique(swapped, return_inverse=True)
        rows = np.zeros((len(contexts), 256))
        np.add.at(rows, (inverse, codes & 255), counts.astype(np.float64))
        last = contexts >> 8
        one = np.zeros((256, 256))
        np.add.at(one, last, rows)
        t1, t0 = _decisions(one), _decisions(one.sum(0, keepdims=True))
        deeper = np.zeros((len(contexts), 256))
        at = np.searchsorted(contexts, keys >> 8)
        known = at < len(contexts)
        known[known] = contexts[at[known]] == (keys >> 8)[known]
        deeper[at[known], (keys & 255)[known]] = below[known]
        weighted2, w2, next2 = np.empty_like(deeper), np.empty_like(deeper), np.empty_like(deeper)
        for x in range(0, len(contexts), 4096):
            t2 = _decisions(rows[x : x + 4096])
            own = _block(t2)
            weighted2[x : x + 4096] = HALF + np.logaddexp(own, deeper[x : x + 4096])
            w2[x : x + 4096] = np.exp(HALF + own - weighted2[x : x + 4096])
            next2[x : x + 4096] = _next(t2)
        sum2 = np.zeros((256, 256))
        np.add.at(sum2, last, weighted2)
        own1, own0 = _block(t1), _block(t0)
        weighted1 = HALF + np.logaddexp(own1, sum2)
        weighted0 = HALF + np.logaddexp(own0, weighted1.sum(0, keepdims=True))
        w1, w0 = np.exp(HALF + own1 - weighted1), np.exp(HALF + own0 - weighted0)
        # rows: the contexts seen, then one for each last byte (its deeper context unseen)
        last = np.concatenate((last, np.arange(256)))
        w2, next2 = np.concatenate((w2, np.full((256, 256), 0.5))), np.concatenate((next2, np.full((256, 256), 0.5)))
        left1 = 1 - w1[last]
        base = w0 * _next(t0) + (1 - w0) * (w1[last] * _next(t1)[last] + left1 * w2 * next2)
        share = (1 - w0) * left1 * (1 - w2)
        row_of = len(contexts) + (np.arange(65536) >> 8)
        row_of[contexts] = np.arange(len(contexts))
        return cls(row_of.astype(np.int32), base.astype(np.float32), share.astype(np.float32))


def _bits(codes: np.ndarray):
    """For each of the eight decisions of the last byte: key (context and node) and the decision."""
    after = codes & 255
    for k in range(8):
        yield (codes >> 8 << 8) | (1 << k) | (after >> (8 - k)), (after >> (7 - k)) & 1


class Deep:
    """The trees below contexts of two bytes, of all strings whose contexts end in some pairs.

    Codes have the byte before the predicted one first, then the one before
    that, and so on, then the predicted byte: a shorter context is a prefix.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, depth: int):
        self.depth, self.levels = depth, []
        keys = np.concatenate([k for k, _ in _bits(codes)] or [codes])
        bits = np.concatenate([b for _, b in _bits(codes)] or [codes])
        keys, inverse = np.unique(keys, return_inverse=True)
        n = np.tile(counts.astype(np.float64), 8)
        one, zero = np.bincount(inverse, weights=n * bits, minlength=len(keys)), np.bincount(inverse, weights=n * (1 - bits), minlength=len(keys))
        weighted = None
        for d in range(depth, 2, -1):
            own = log_gamma(zero + 0.5) + log_gamma(one + 0.5) - log_gamma(zero + one + 1) - math.log(math.pi)
            mixed = own if weighted is None else HALF + np.logaddexp(own, weighted)
            weight = np.ones_like(own) if weighted is None else np.exp(HALF + own - mixed)
            self.levels.append((keys, weight, (one + 0.5) / (zero + one + 1.0)))
            shorter, inverse = np.unique((keys >> 16 << 8) | (keys & 255), return_inverse=True)
            add = lambda x: np.bincount(inverse, weights=x, minlength=len(shorter))  # noqa: B023, E731
            weighted, zero, one, keys = add(mixed), add(zero), add(one), shorter
        self.keys, self.below = keys, weighted

    def log10(self, codes: np.ndarray, top: Top) -> np.ndarray:
        """log10 probabilities of the codes it was built from."""
        row = top.row_of[codes >> (8 * (self.depth - 1))]
        out = np.zeros(len(codes))
        for key, bit in _bits(codes):
            p = np.full(len(codes), 0.5)
            for level, (keys, weight, estimate) in enumerate(self.levels):
                at = np.searchsorted(keys, ((key >> 8 >> (8 * level)) << 8) | (key & 255))
                p = weight[at] * estimate[at] + (1 - weight[at]) * p
            p = top.base[row, key & 255] + top.share[row, key & 255] * p
            out += np.log10(np.clip(np.where(bit == 1, p, 1 - p), 1e-300, 1.0))
        return out


def strings(data: bytes, ends: np.ndarray, depth: int) -> np.ndarray:
    """Code of (bytes before, nearest first, and byte) at every position of texts that end at ``ends``; contexts never cross texts."""
    x = np.frombuffer(data, np.uint8).astype(np.int64)
    out, before = x.copy(), x
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else np.empty(0, np.int64)
    for d in range(1, depth + 1):
        before = np.concatenate((np.zeros(1, np.int64), before[:-1])) if len(before) else before
        before[starts] = 0
        out |= before << (8 * (depth + 1 - d))
    return out


def triples(codes: np.ndarray, depth: int) -> np.ndarray:
    """Codes of (two bytes before, in reading order, and byte) of longer strings."""
    return ((codes >> (8 * (depth - 1)) & 255) << 16) | ((codes >> (8 * depth)) << 8) | (codes & 255)


def held_out(doc_id, modulus: int) -> bool:
    """crc32 of the id as text modulo ``modulus`` is 0."""
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % modulus == 0


def _words(texts: list[bytes], words: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, each with its end, and the number of tokens of each text."""
    found = [t.lower().split() for t in texts]
    sizes = np.array([len(f) + 1 for f in found], dtype=np.int64)
    out = np.empty(int(sizes.sum()), np.uint64)
    at = 0
    for f in found:
        out[at : at + len(f)] = np.fromiter(map(words.__getitem__, f), np.uint64, len(f))
        at += len(f)
        out[at] = END_WORD
        at += 1
    return out, sizes


def _ranges(unique: np.ndarray, ranges: int) -> np.ndarray:
    """Where each hash range begins in sorted hashes (ranges + 1 numbers)."""
    of = ((unique >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(of, np.arange(ranges + 1, dtype=np.uint64))


BATCHES = pa.schema([("kind", pa.int32()), ("batch", pa.int64()), ("range", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])


def _packed(codes: np.ndarray) -> bytes:
    """Sorted numbers as differences, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.diff(codes, prepend=0).tobytes())


def _unpacked(blob) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob.as_py()), np.int64))


def _range_of(codes: np.ndarray, ranges: int) -> np.ndarray:
    h = mix64(codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _parts(codes: np.ndarray, of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(range, places of its codes in order) for sorted codes."""
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.diff(of[order], prepend=-1, append=-2))
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(of[order[x]]), order[x:y]


def _counted(texts: list[bytes], train: np.ndarray, depth: int, at_once: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings of the texts, sorted, and how often those to learn from have them; a part of the texts at a time."""

    def merge(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(codes)
        codes = codes[order]
        begin = np.flatnonzero(np.diff(codes, prepend=-1))
        return codes[begin], np.add.reduceat(counts[order], begin)

    found, first, held = [], 0, 0
    for i, t in enumerate(texts):
        held += len(t) + 1
        if held >= at_once or i == len(texts) - 1:
            part = texts[first : i + 1]
            ends = np.cumsum([len(x) + 1 for x in part])
            codes = (strings(b"\0".join(part) + b"\0", ends, depth) << 1) | np.repeat(train[first : i + 1], [len(x) + 1 for x in part])
            codes.sort()
            begin = np.flatnonzero(np.diff(codes >> 1, prepend=-1))
            found.append((codes[begin] >> 1, np.add.reduceat(codes & 1, begin)))
            first, held = i + 1, 0
    codes, counts = merge(*(np.concatenate(x) for x in zip(*found, strict=True)))
    return codes, counts.astype(np.uint32)


def _batches(docs: DataFrame, modulus: int, ranges: int, batch_bytes: int, depth: int) -> DataFrame:
    """Four kinds of rows: 0 word hashes and training counts of a batch and range, 1 a batch's documents, 2 triples of a
    task and range, 3 strings and training counts of a batch and range."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = WordHashes(), zstandard.ZstdCompressor(level=1)
        totals = np.zeros(1 << 24, dtype=np.uint32)
        number = TaskContext.get().partitionId() << 32

        def flush(ids: list, texts: list[bytes]) -> pa.RecordBatch:
            train = np.array([not held_out(i, modulus) for i in ids])
            tokens, sizes = _words(texts, words)
            unique, inverse = np.unique(tokens, return_inverse=True)
            counts = np.bincount(inverse[np.repeat(train, sizes)], minlength=len(unique)).astype(np.uint32)
            cuts = _ranges(unique, ranges)
            rows = [(0, number, r, unique[x:y].tobytes(), counts[x:y].tobytes()) for r, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if x < y]
            lengths = np.array([len(t) for t in texts], dtype=np.int64)
            known = np.array([i is not None for i in ids])
            header = np.column_stack((np.array([0 if i is None else i for i in ids], dtype=np.int64), known.astype(np.int64), lengths))
            rows.append((1, number, -1, header.tobytes(), packer.compress(b"".join(texts))))
            del tokens, inverse
            codes, learned = _counted(texts, train, depth)
            three = triples(codes, depth)
            np.add.at(totals, three, learned)
            rows += [(3, number, r, _packed(codes[at]), packer.compress(learned[at].tobytes())) for r, at in _parts(codes, _range_of(codes, ranges))]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), BATCHES, strict=True)], schema=BATCHES)

        ids, texts, held = [], [], 0
        for batch in incoming:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                ids.append(doc)
                texts.append(raw)
                held += len(raw)
                if held >= batch_bytes:
                    yield flush(ids, texts)
                    ids, texts, held, number = [], [], 0, number + 1
        if ids:
            yield flush(ids, texts)
        seen = np.flatnonzero(totals).astype(np.int32)
        cuts = np.searchsorted(seen, np.arange(COUNT_RANGES + 1) << 18)
        rows = [(2, number, r, seen[x:y].tobytes(), totals[seen[x:y]].astype(np.int64).tobytes()) for r, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if x < y]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), BATCHES, strict=True)], schema=BATCHES)

    return docs.mapInArrow(run, "kind int, batch long, range int, a binary, b binary")


def _add_triples(key: tuple, table: pa.Table) -> pa.Table:
    first = key[0].as_py() << 18
    total = np.zeros(1 << 18, dtype=np.int64)
    for a, b in zip(table["a"], table["b"], strict=True):
        total[np.frombuffer(a.as_buffer(), np.int32) - first] += np.frombuffer(b.as_buffer(), np.int64)
    seen = np.flatnonzero(total)
    return pa.table({"a": [(seen + first).astype(np.int32).tobytes()], "b": [total[seen].tobytes()]}, schema=pa.schema([("a", pa.binary()), ("b", pa.binary())]))


GRAMS = pa.schema([("range", pa.int32()), ("codes", pa.binary()), ("counts", pa.binary())])
GRAMS_DDL = "range int, codes binary, counts binary"


def _add_strings(ranges: int, depth: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Totals of a hash range's strings, dealt by the two last bytes of their contexts."""
        unpack = zstandard.ZstdDecompressor()
        codes, inverse = np.unique(np.concatenate([_unpacked(x) for x in table["a"]]), return_inverse=True)
        counts = np.concatenate([np.frombuffer(unpack.decompress(x.as_py()), np.uint32) for x in table["b"]])
        total = np.bincount(inverse, weights=counts, minlength=len(codes)).astype(np.int64)
        rows = [(r, _packed(codes[at]), total[at].tobytes()) for r, at in _parts(codes, _range_of(codes >> (8 * (depth - 1)), ranges))]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), GRAMS, strict=True)], schema=GRAMS)

    return run


def _gathered(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    codes = np.concatenate([_unpacked(x) for x in table["codes"]])
    order = np.argsort(codes)
    return codes[order], np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table["counts"]])[order]


def _below(depth: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        deep = Deep(*_gathered(table), depth)
        return pa.table({"keys": [deep.keys.tobytes()], "below": [deep.below.tobytes()]}, schema=pa.schema([("keys", pa.binary()), ("below", pa.binary())]))

    return run


def _probabilities(depth: int, ranges: int, shared):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """log10 probabilities of a context range's strings, dealt by the hash ranges that batches asked."""
        codes, counts = _gathered(table)
        found = Deep(codes, counts, depth).log10(codes, Top(*shared.value)).astype(np.float32)
        rows = [(r, _packed(codes[at]), found[at].tobytes()) for r, at in _parts(codes, _range_of(codes, ranges))]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), GRAMS, strict=True)], schema=GRAMS)

    return run


ANSWERS = pa.schema([("batch", pa.int64()), ("codes", pa.binary()), ("log10", pa.binary())])


def _answer(key: tuple, asked: pa.Table, known: pa.Table) -> pa.Table:
    codes = np.concatenate([_unpacked(x) for x in known["codes"]])
    values = np.concatenate([np.frombuffer(x.as_buffer(), np.float32) for x in known["counts"]])
    order = np.argsort(codes)
    codes, values = codes[order], values[order]
    out = [values[np.searchsorted(codes, _unpacked(x))].tobytes() for x in asked["a"]]
    return pa.table([asked["batch"], asked["a"], pa.array(out, pa.binary())], schema=ANSWERS)


TOTALS = pa.schema([("batch", pa.int64()), ("range", pa.int32()), ("totals", pa.binary()), ("words", pa.int64()), ("tokens", pa.int64())])


def _add_words(key: tuple, table: pa.Table) -> pa.Table:
    """Totals of a hash range, sent back to each batch in the order of its own hashes."""
    hashes = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["a"]]
    counts = [np.frombuffer(x.as_buffer(), np.uint32) for x in table["b"]]
    unique, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(unique)).astype(np.int64)
    parts = np.split(total[inverse], np.cumsum([len(h) for h in hashes])[:-1])
    words, tokens = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    words[0], tokens[0] = (total > 0).sum(), total.sum()
    return pa.table([table["batch"], table["range"], pa.array([p.tobytes() for p in parts], pa.binary()), pa.array(words), pa.array(tokens)], schema=TOTALS)


RESULT_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"


def _summed(codes: np.ndarray, values: np.ndarray, texts: list[bytes], depth: int, at_once: int = 1 << 20) -> np.ndarray:
    """Sum of the values of each text's strings, a part of the texts at a time."""
    out, part, held = [], [], 0
    for i, t in enumerate(texts):
        part.append(t)
        held += len(t) + 1
        if held >= at_once or i == len(texts) - 1:
            ends = np.cumsum([len(x) + 1 for x in part])
            found = values[np.searchsorted(codes, strings(b"\0".join(part) + b"\0", ends, depth))]
            out.append(np.add.reduceat(found, np.concatenate(([0], ends[:-1]))))
            part, held = [], 0
    return np.concatenate(out)


def score(docs: DataFrame, modulus: int = 10, id_col: str = "doc_id", text_col: str = "text", docs_per_range: int = 4000, batch_bytes: int = 8 << 20, depth: int = 4) -> DataFrame:
    """Scores of all documents by models of those whose id hash is not 0 modulo ``modulus``.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10 probability of the text), n_bytes, bits_per_byte.
    """
    if not 3 <= depth <= 6:
        raise ValueError("depth must be 3 to 6 bytes")
    spark = docs.sparkSession
    scratch = Scratch(spark, "context-tree")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ranges = max(8, math.ceil(docs.count() / docs_per_range))
    _batches(docs, modulus, ranges, batch_bytes, depth).write.partitionBy("kind").option("compression", "uncompressed").parquet(scratch.path("batches"))
    rows = scratch.get("batches", "kind int, batch long, range int, a binary, b binary")
    empty = not rows.limit(1).count()
    if empty:
        return spark.createDataFrame([], RESULT_DDL)

    merged = rows.where("kind = 2").select("range", "a", "b").groupBy("range").applyInArrow(_add_triples, "a binary, b binary").collect()
    codes = np.concatenate([np.frombuffer(r["a"], np.int32) for r in merged] or [np.empty(0, np.int32)])
    counts = np.concatenate([np.frombuffer(r["b"], np.int64) for r in merged] or [np.empty(0, np.int64)])
    asked = rows.where("kind = 3").select("batch", "range", "a", "b")
    sums = scratch.put(asked.groupBy("range").applyInArrow(_add_strings(COUNT_RANGES, depth), GRAMS_DDL), "strings")
    deeper = sums.groupBy("range").applyInArrow(_below(depth), "keys binary, below binary").collect()
    keys = np.concatenate([np.frombuffer(r["keys"], np.int64) for r in deeper])
    below = np.concatenate([np.frombuffer(r["below"], np.float64) for r in deeper])
    top = Top.build(codes, counts, keys, below)
    shared = spark.sparkContext.broadcast((top.row_of, top.base, top.share))
    found = sums.groupBy("range").applyInArrow(_probabilities(depth, ranges, shared), GRAMS_DDL)
    answers = asked.select("batch", "range", "a").groupBy("range").cogroup(found.groupBy("range")).applyInArrow(_answer, "batch long, codes binary, log10 binary")
    answers = scratch.put(answers, "answers")

    totals = scratch.put(rows.where("kind = 0").select("batch", "range", "a", "b").groupBy("range").applyInArrow(_add_words, "batch long, range int, totals binary, words long, tokens long"), "totals")
    n_words, n_tokens = (x or 0 for x in totals.agg(F.sum("words"), F.sum("tokens")).first())
    all_mass = n_tokens + 0.1 * (n_words + 1)
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")

    def finish(key: tuple, batch: pa.Table, replies: pa.Table) -> pa.Table:
        hashes, unpack = WordHashes(), zstandard.ZstdDecompressor()
        out: list[list] = [[] for _ in names]
        for header, body in zip(batch["a"], batch["b"], strict=True):
            head = np.frombuffer(header.as_buffer(), np.int64).reshape(-1, 3)
            data, bounds = unpack.decompress(body.as_py()), np.concatenate(([0], np.cumsum(head[:, 2])))
            texts = [data[x:y] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
            tokens, sizes = _words(texts, hashes)
            _, inverse = np.unique(tokens, return_inverse=True)
            words = replies.filter(pc.is_valid(replies["range"]))
            order = np.argsort(words["range"].to_numpy())
            blobs = words["totals"].to_pylist()
            total = np.concatenate([np.frombuffer(blobs[i], np.int64) for i in order])
            begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            base = np.add.reduceat(np.log10((total + 0.1) / all_mass)[inverse], begin)
            known = np.add.reduceat((total > 0).astype(np.int64)[inverse], begin)
            grams = replies.filter(pc.is_null(replies["range"]))
            known_codes = np.concatenate([_unpacked(x) for x in grams["codes"]])
            sort = np.argsort(known_codes)
            values = np.concatenate([np.frombuffer(x.as_buffer(), np.float32) for x in grams["totals"]])[sort].astype(np.float64)
            known_codes = known_codes[sort]
            found = _summed(known_codes, values, texts, depth)
            ids = [i if k else None for i, k in zip(head[:, 0].tolist(), head[:, 1].tolist(), strict=True)]
            bits = -found / (head[:, 2] + 1) * math.log2(10)
            columns = (ids, [held_out(i, modulus) for i in ids], sizes, known, np.full(len(ids), n_tokens), base, found, head[:, 2], bits)
            for o, c in zip(out, columns, strict=True):
                o.extend(c.tolist() if isinstance(c, np.ndarray) else c)
        return pa.table([pa.array(o, t) for o, t in zip(out, (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.float64()), strict=True)], names=list(names))

    left = rows.where("kind = 1").select("batch", "a", "b").groupBy("batch")
    none = F.lit(None)
    right = totals.select("batch", "range", "totals", none.cast("binary").alias("codes"))
    right = right.unionByName(answers.select("batch", none.cast("int").alias("range"), F.col("log10").alias("totals"), "codes")).groupBy("batch")
    return left.cogroup(right).applyInArrow(finish, RESULT_DDL)
