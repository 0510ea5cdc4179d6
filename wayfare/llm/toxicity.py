"""Toxicity scores from subword-bag embeddings and a linear softmax.

A word is the bag of its character 3- to 6-grams, hashed into ``buckets``
vectors of ``dim`` numbers; a window of words is the average of its words'
bags; a linear softmax over two classes scores the window and the document has
the score of its most toxic window, so that a few words in a long text count.
Vectors and softmax are trained jointly, in numpy on the driver, on a sample of
the labelled documents that is bounded in rows (``max_rows``) and in bytes of
text (``max_bytes``).  Misspellings that training never saw share n-gram
vectors with known words.

Training sees whole documents as one window first, then the most toxic window
of each.  The trained model is ``buckets`` numbers, its size does not grow with
the data; scoring is one scan of the whole texts and no shuffle.

Edge cases: null or empty texts have no window and the score of the bias
alone; without labelled rows, or with one class only, every score is the
smoothed share of toxic labels; several labels of one document count as toxic
if any is; of equally toxic windows the first counts; null ids are scored and
never trained on; repeated rows are scored again; very long texts are scored
whole; an empty table gives an empty result; extra columns, whatever their
names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import tidy
from .minhash import mix64

_PRIME, _STEP = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
TRIM = b".,;:!?\"'()[]{}|*#$%&<>-_"


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of a text without punctuation around them."""
    return (text or "").lower().encode("utf-8", "replace").split()


def subwords(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of the character 3- to 6-grams of words, ``<`` and ``>`` marking their ends; word numbers rise.

    All grams of one length are hashed at once, by a polynomial of code points.
    A word of punctuation alone has the gram ``<>``.
    """
    marked = ["<" + w.strip(TRIM).decode("utf-8", "replace") + ">" for w in words]
    x = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    owner = np.repeat(np.arange(len(marked)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(x))  # characters of the word from here on
    whole = np.repeat(sizes, sizes)
    h, owners, found = x, [], []
    for k in range(2, 7):
        h = h[:-1] * _PRIME + x[k - 1 :]
        n = len(h)
        here = np.flatnonzero((left[:n] >= k) & ((whole[:n] == 2) if k == 2 else True))
        owners.append(owner[here])
        found.append((mix64(h[here] + np.array([k], np.uint64) * _STEP) % np.uint64(buckets)).astype(np.int32))
        if not n:
            break
    order = np.argsort(np.concatenate(owners), kind="stable")
    return np.concatenate(owners)[order], np.concatenate(found)[order]


def best_window(margins: np.ndarray, width: int) -> tuple[int, int, float]:
    """(start, end, average) of the window with the largest average margin; texts up to the width are one window."""
    n = len(margins)
    if n <= width:
        return 0, n, float(margins.mean()) if n else 0.0
    total = np.concatenate(([0.0], np.cumsum(margins, dtype=np.float64)))
    sums = total[width:] - total[:-width]
    at = int(sums.argmax())
    return at, at + width, float(sums[at] / width)


@dataclass
class Model:
    """margin(window) = bias + average over words of the average of ``weights`` of their subwords."""

    weights: np.ndarray
    bias: float
    width: int

    def word_margins(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.empty(0)
        owner, bucket = subwords(words, len(self.weights))
        return np.bincount(owner, weights=self.weights[bucket], minlength=len(words)) / np.bincount(owner, minlength=len(words))

    def word_margin(self, word: bytes) -> float:
        return float(self.word_margins([word])[0])


class Margins(dict):
    """Margins of words, remembered up to a bound; new words are looked at together."""

    def __init__(self, model: Model, most: int = 300_000):
        super().__init__()
        self.model, self.most = model, most

    def of(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        if len(self) > self.most:
            self.clear()
        new = list({w for t in texts for w in t if w not in self})
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            self.update(zip(part, self.model.word_margins(part).tolist(), strict=True))
        return [np.fromiter(map(self.__getitem__, t), np.float32, len(t)) for t in texts]


def train(texts: list[str | None], labels: list[int], buckets: int = 1 << 16, dim: int = 8, width: int = 5, epochs: tuple[int, int] = (60, 140), rate: float = 0.05, decay: float = 1e-2, seed: int = 7) -> Model:
    """Joint training of subword vectors and softmax by Adam on full batches."""
    y = np.array(labels, dtype=float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model(np.zeros(buckets, np.float32), float(np.log(share / (1 - share))), width)
    vocabulary: dict[bytes, int] = {}
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)], dtype=np.int32) for t in texts]
    words = list(vocabulary) or [b""]
    parts = [subwords(words[at : at + 20_000], buckets) for at in range(0, len(words), 20_000)]
    flat, n_words = np.concatenate([bucket for _, bucket in parts]), len(words)
    sizes = np.concatenate([np.bincount(owner, minlength=min(20_000, n_words - 20_000 * i)) for i, (owner, _) in enumerate(parts)])
    first = np.concatenate(([0], np.cumsum(sizes)))
    del vocabulary, words, parts
    # words in pieces, so that temporary arrays stay small
    pieces = [(w, min(n_words, w + 65536)) for w in range(0, n_words, 65536)]
    rng = np.random.default_rng(seed)
    vectors, softmax, bias = rng.normal(0, 0.1, (buckets, dim)), rng.normal(0, 1, dim), 0.0
    moments = [[np.zeros_like(vectors), np.zeros_like(vectors)], [np.zeros(dim), np.zeros(dim)], [0.0, 0.0]]
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    scale = float(width)
    for step in range(1, sum(epochs) + 1):
        value = vectors @ softmax
        margins = np.concatenate([np.add.reduceat(value[flat[first[w] : first[x]]], first[w:x] - first[w]) for w, x in pieces]) * scale / sizes
        whole = step <= epochs[0]
        spans = [(0, len(d), float(margins[d].mean()) if len(d) else 0.0) if whole else best_window(margins[d], width) for d in docs]
        p = 1 / (1 + np.exp(-np.clip(bias + np.array([s[2] for s in spans]), -40, 40)))
        g = (p - y) * weight
        used = [d[s[0] : s[1]] for d, s in zip(docs, spans, strict=True)]
        lengths = np.array([max(1, len(u)) for u in used])
        per_word = np.bincount(np.concatenate(used), weights=np.repeat(g / lengths, [len(u) for u in used]), minlength=n_words) * scale / sizes
        per_bucket = np.zeros(buckets)
        for w, x in pieces:
            per_bucket += np.bincount(flat[first[w] : first[x]], weights=np.repeat(per_word[w:x], sizes[w:x]), minlength=buckets)
        grads = [per_bucket[:, None] * softmax[None, :] + decay * vectors / len(y), per_bucket @ vectors + decay * softmax, float(g.sum())]
        values = [vectors, softmax, bias]
        for k, grad in enumerate(grads):
            m = moments[k][0] = 0.9 * moments[k][0] + 0.1 * grad
            v = moments[k][1] = 0.999 * moments[k][1] + 0.001 * grad**2
            values[k] = values[k] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        vectors, softmax, bias = values
    return Model((scale * (vectors @ softmax)).astype(np.float32), float(bias), width)


def calibrated(model: Model, texts: list[str | None], labels: list[int]) -> Model:
    """``model`` with scale and bias fitted by logistic regression to documents it was not trained on."""
    y = np.array(labels, dtype=float)
    if not len(y) or y.min() == y.max():
        return model
    margins = Margins(model)
    x = np.array([best_window(m, model.width)[2] for t in texts for m in margins.of([words_of(t)])])
    spread = x.std() or 1.0
    z = np.column_stack((x / spread, np.ones(len(x))))
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        beta = beta - np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2), z.T @ (p - y) + 1e-2 * beta)
    factor = max(float(beta[0] / spread), 1e-3)
    return Model((model.weights * factor).astype(np.float32), float(beta[1]), model.width)


def sample(documents: DataFrame, labels: DataFrame, max_rows: int, max_bytes: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, label) of at most ``max_rows`` labelled documents and ``max_bytes`` of text, those with the smallest hashes of the id.

    The hash threshold comes from the number of labels, so that only about the
    rows that are wanted are sorted.  An id of several documents gives its
    smallest text; texts above a 64th of ``max_bytes`` take no part in training.
    """
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).alias("label"))
    n = marked.count()
    part = F.pmod(F.xxhash64("__id"), F.lit(1 << 30))
    below = 1 << 30 if n <= 2 * max_rows else math.ceil((1 << 30) * 1.5 * max_rows / n)
    chosen = marked.withColumn("__part", part).where(F.col("__part") < below).orderBy("__part", "__id").limit(max_rows)
    texts = documents.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = texts.join(F.broadcast(chosen), "__id").where(F.octet_length("text") <= max_bytes // 64)
    texts = texts.groupBy("__id", "__part").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    order = Window.orderBy("__part", "__id")  # over max_rows rows at most
    upto = F.sum(F.octet_length("text").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return texts.withColumn("__upto", upto).where(F.col("__upto") <= max_bytes).orderBy("__part", "__id").select("text", "label")


def fit(
    documents: DataFrame, labels: DataFrame, max_rows: int = 8192, max_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **params
) -> Model:
    """Train on a bounded :func:`sample` of the labelled documents given; every fifth of them calibrates scale and bias."""
    rows = sample(documents, labels, max_rows, max_bytes, id_col, text_col, label_col).collect()
    texts, marks = [r["text"] for r in rows], [int(r["label"] > 0) for r in rows]
    held = [i % 5 == 4 for i in range(len(rows))]
    pick = lambda values, part: [v for v, h in zip(values, held, strict=True) if h == part]
    model = train(pick(texts, False), pick(marks, False), **params)
    return calibrated(model, pick(texts, True), pick(marks, True))


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): probability of the toxic class for each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margins = Margins(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [words_of(text.as_py()) for text in part.column(1)]
                found = [model.bias + best_window(m, model.width)[2] for m in margins.of(texts)]
                p = 1 / (1 + np.exp(-np.clip(np.array(found, dtype=np.float64), -40, 40)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p, pa.float64())], names=[id_col, "score"])

    narrow = documents.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col))
    return narrow.mapInArrow(tidy(run), f"`{id_col}` long, score double")
