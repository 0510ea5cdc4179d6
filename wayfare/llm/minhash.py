"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document is the set of its distinct ``k``-word shingles.  Its sketch has
``t`` coordinates, filled in rounds: round ``i`` throws every element into a
hashed bin with a hashed value; a coordinate is the smallest (round, value)
that reached its bin.  Rounds ``t`` to ``2t - 1`` throw all elements into one
bin each, so every coordinate is filled whatever the set's size, and the share
of equal coordinates is concentrated around the Jaccard similarity.  Time is
O(n + t log t) per document rather than O(n t).

Bands of ``rows`` coordinates make candidate buckets.  With the default 48
bands of 6 rows two documents of similarity 0.8 share no bucket with
probability (1 - 0.8**6)**48 < 5e-7, less for all higher similarities.

Links are confirmed on the full sets.  No bucket is expanded into all its
pairs: members are tested against a pivot; buckets whose members are in one
component by then need nothing more; in the rest, further pivots follow and at
last an exact prefix filter finds all pairs of members of different components
that can still be linked, so that no candidate link is lost.  Equal sets are one class
and only their smallest id takes part; links and components stay distributed.

Edge cases: null or empty texts and texts without words have an empty set and
are linked with nothing; a text with fewer than ``k`` words is one shingle of
all its words; repeated rows are equal sets; a null id counts as larger than all
ids; rows that share an id are documents of their own; an empty table gives an
empty result; texts are read whole; extra columns, whatever their names, are
ignored by the query and kept by :func:`keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.operators.components import connected_components

from .common import ROW_KEY, Scratch, tidy, with_row_key

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_S30, _S27, _S31, _S32 = (np.uint64(x) for x in (30, 27, 31, 32))
_LOW = np.uint64(0xFFFFFFFF)
#: Candidates up to which their keys are broadcast (about 100 bytes each in a hash table); beyond, the join shuffles.
BROADCAST_ROWS = 150_000
#: An element in more sets than this, or than a millionth of all elements, is frequent: its count is broadcast (at most a million of them).
FREQUENT, FREQUENT_SHARE = 1_000, 1_000_000


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str | None, k: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles (A-Z lower-cased, words by ASCII white space)."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, n)
    width = min(k, n)
    out = np.full(n - width + 1, np.uint64(width))
    for j in range(width):
        out = mix64(out * _STEP + h[j : n - width + 1 + j])
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def sketch(items: np.ndarray, t: int) -> np.ndarray:
    """The t filled coordinates of a non-empty set of 64-bit hashes."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out, n, done = np.full(t, empty), len(items), 0
    while done < t:
        rounds = min(t - done, max(1, int(np.ceil(t * (np.log(t) + 4) / n))))
        numbers = np.arange(done, done + rounds, dtype=np.uint64)
        z = mix64(items[None, :] ^ mix64(numbers * _STEP + _STEP)[:, None])
        bins = ((z >> _S32) * np.uint64(t)) >> _S32
        np.minimum.at(out, bins.ravel().astype(np.intp), (((numbers << _S32)[:, None]) | (z & _LOW)).ravel())
        done += rounds
        if not (out == empty).any():
            return out
    for b in np.flatnonzero(out == empty):
        number = np.array([t + b], dtype=np.uint64)
        out[b] = ((number << _S32) | (mix64(items ^ mix64(number * _STEP + _STEP)) & _LOW)).min()
    return out


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = mix64(np.arange(1, bands + 1, dtype=np.uint64) * _STEP)
    for j in range(rows):
        key = mix64(key * _STEP + coordinates.reshape(bands, rows)[:, j])
    return key.view(np.int64)


def sketches(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """(row key, doc_id, text) -> (row key, doc_id, n_shingles, set_id, keys): set_id is a 128-bit digest of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                n, ids, keys = [], [], []
                for text in part.column(3):
                    items = shingle_set(text.as_py(), k, words)
                    n.append(len(items))
                    ids.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
                    keys.append(band_keys(sketch(items, bands * rows), bands, rows) if len(items) else None)
                found = [pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *found], names=[*ROW_KEY, "doc_id", "n_shingles", "set_id", "keys"])

    return docs.mapInArrow(tidy(run), f"{ROW_KEY[0]} long, {ROW_KEY[1]} long, doc_id long, n_shingles long, set_id binary, keys array<long>")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """(node, text) -> (node, items): the set's sorted hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                items = [shingle_set(t.as_py(), k, words).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(items, pa.binary())], names=["rep", "items"])

    return docs.mapInArrow(tidy(run), "rep long, items binary")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
                    keep.append(False)
                    continue
                both = np.concatenate((p, q))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("rep").alias("a"), F.col("items").alias("p"))
    right = sets.select(F.col("rep").alias("b"), F.col("items").alias("q"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "p", "q").mapInArrow(tidy(run), "a long, b long")


def _ordered(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.where(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


class _Groups:
    """Links found so far and the components they make, over class representatives."""

    def __init__(self, scratch: Scratch, sets: DataFrame, percent: int):
        self.scratch, self.sets, self.percent, self.tested, self.components, self.n = scratch, sets, percent, None, None, 0

    def of(self, df: DataFrame, column: str = "rep") -> DataFrame:
        """``df`` with ``component`` of ``column`` (itself if it has no link)."""
        if self.components is None:
            return df.withColumn("component", F.col(column))
        known = self.components.select(F.col("node").alias(column), "component")
        return df.join(known, column, "left").withColumn("component", F.coalesce("component", column))

    def test(self, pairs: DataFrame) -> None:
        """Confirm pairs (a, b) that were not tested before; merge the components of those linked."""
        self.n += 1
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = self.scratch.put(pairs, f"pairs{self.n}")
        links = self.scratch.put(_linked(pairs, self.sets, self.percent), f"links{self.n}")
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        merged = self.of(self.of(links, "a").withColumnRenamed("component", "ca"), "b").select("ca", F.col("component").alias("cb"))
        parts = connected_components(merged.where("ca <> cb"), "ca", "cb").select(F.col("node").alias("component"), F.col("component").alias("root"))
        nodes = links.select(F.explode(F.array("a", "b")).alias("node"))
        if self.components is not None:
            nodes = nodes.unionByName(self.components.select("node"))
        now = self.of(nodes.distinct(), "node").join(parts, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
        self.components = self.scratch.put(now, f"components{self.n}")


def _mixed(members: DataFrame) -> DataFrame:
    """Of (key, rep, component): the keys with members of more than one component."""
    span = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return span.where("low <> high").select("key")


def _pivot_pairs(members: DataFrame, salt: int) -> DataFrame:
    """Each member of a mixed bucket with the bucket's pivot, a member drawn by a salted hash (0: the smallest id)."""
    order = F.col("rep") if not salt else F.xxhash64("rep", F.lit(salt))
    pivots = members.groupBy("key").agg(F.min(F.struct(order.alias("o"), "rep", "component")).alias("p"))
    pivots = pivots.select("key", F.col("p.rep").alias("pivot"), F.col("p.component").alias("pivot_component"))
    hit = members.join(pivots, "key").where("component <> pivot_component")
    return _ordered(hit, "rep", "pivot")


class _Found:
    """What a search has found: ``seen`` (a row per document), ``classes`` (a row per set) and ``placed`` (set_id, group, component_id)."""

    def __init__(self, seen: DataFrame, classes: DataFrame, components: DataFrame):
        linked = components.join(classes.select("node", "set_id", "least"), "node")
        least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
        groups = components.join(least, "component").select("node", F.col("component").alias("group"), "component_id")
        placed = classes.join(groups, "node", "left")
        self.seen, self.classes = seen, classes
        self.placed = placed.select("set_id", "node", F.coalesce("group", "node").alias("group"), F.coalesce("component_id", "least").alias("component_id"), "least")


def _search(docs: DataFrame, scratch: Scratch, k: int, percent: int, bands: int, rows: int, first_bands: int, pivots: int) -> _Found:
    """Search (row key, doc_id, text).  Nodes are sets, each with the number of its row in a written table, so that ids may repeat or be missing."""
    seen = scratch.put(sketches(docs, k, bands, rows), "sketches")
    # the row with the smallest id stands for its set; a place in the table decides between rows of one id
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *ROW_KEY)
    classes = seen.where("set_id is not null").groupBy("set_id").agg(F.min(first).alias("f"))
    classes = classes.select("set_id", F.col("f.doc_id").alias("least"), *[F.col(f"f.{c}").alias(c) for c in ROW_KEY])
    classes = scratch.put(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    nodes = seen.join(classes.select("node", *ROW_KEY), list(ROW_KEY)).select(*ROW_KEY, F.col("node").alias("rep"), F.col("n_shingles").alias("n"), "keys")
    nodes = scratch.put(nodes, "nodes")

    def buckets(first: int, count: int) -> DataFrame:
        return nodes.select("rep", "n", F.explode(F.slice("keys", first, count)).alias("key"))

    def sharing(entries: DataFrame) -> DataFrame:
        return entries.join(_mixed(entries.withColumn("component", F.col("rep"))), "key")

    def sets_of(reps: DataFrame, name: str) -> DataFrame:
        """Full sets of some nodes; the list of their rows is broadcast only while it is small."""
        chosen = scratch.put(nodes.select("rep", *ROW_KEY).join(reps, "rep", "left_semi"), f"rows-{name}")
        if chosen.count() <= BROADCAST_ROWS:
            chosen = F.broadcast(chosen)
        return scratch.put(_sets(docs.join(chosen, list(ROW_KEY)).select("rep", "text"), k), name)

    # A few bands bring most copies together; all bands are then looked at by component.
    opening = scratch.put(sharing(buckets(1, first_bands)), "opening")
    groups = _Groups(scratch, None, percent)
    groups.sets = sets_of(opening.select("rep").distinct(), "sets0")
    groups.test(_pivot_pairs(opening.withColumn("component", F.col("rep")), 0))

    placed = groups.of(nodes.select("rep", "n", "keys")).select("rep", "n", "component", F.explode("keys").alias("key"))
    members = scratch.put(placed.join(_mixed(placed), "key").select("key", "rep", "n"), "members")
    more = members.select("rep").distinct().join(groups.sets.select("rep"), "rep", "left_anti")
    groups.sets = groups.sets.unionByName(sets_of(more, "sets1"))
    for salt in range(pivots):
        groups.test(_pivot_pairs(_still_mixed(groups.of(members)), salt))
    rest = _still_mixed(groups.of(members)).select("rep", "n", "component").distinct()
    groups.test(_prefix_pairs(scratch.put(rest, "rest"), groups.sets, percent, scratch))
    return _Found(seen, classes, groups.components)


def _prepared(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(docs with row keys, (row key, doc_id, text))."""
    keyed = with_row_key(docs, scratch)
    return keyed, keyed.select(*ROW_KEY, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, bands: int = 48, rows: int = 6, first_bands: int = 4, pivots: int = 2) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable over links)."""
    scratch = Scratch(docs.sparkSession, "minhash")
    found = _search(_prepared(docs, scratch, id_col, text_col)[1], scratch, k, percent, bands, rows, first_bands, pivots)
    out = found.seen.select("doc_id", "n_shingles", "set_id").join(found.placed.select("set_id", "component_id"), "set_id", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _prefix_pairs(rest: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """All pairs of ``rest`` (rep, n, component) in different components that can still be linked.

    Exact prefix and position filters: with the elements of every set ordered
    from rare to frequent, sets that are similar enough have their first common
    element at places i and j that leave enough for the needed overlap,
    1 + min(n - i, m - j) >= percent * (n + m) / (100 + percent).  Copies of a
    page with many own words have these first and match nothing.  Of an
    element's rows those in its most frequent component need not meet each
    other, so only the others are joined with all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                items = np.frombuffer(batch.column(2)[i].as_buffer(), np.int64)
                rep, n = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(items), rep)), pa.array(np.full(len(items), n)), pa.array(items)], names=["rep", "n", "e"])

    elements = scratch.put(rest.select("rep", "n").join(sets, "rep").select("rep", "n", "items").mapInArrow(tidy(run), "rep long, n long, e long"), "elements")
    frequency = elements.groupBy("e").agg(F.count(F.lit(1)).alias("df"))
    place = F.row_number().over(Window.partitionBy("rep").orderBy("df", "e")).cast("long")
    frequency = scratch.put(frequency, "frequency")
    most = max(FREQUENT, elements.count() // FREQUENT_SHARE)
    # the rows of a frequent element stay where they are; only rare ones, each a bounded group, are dealt by element
    often = frequency.where(F.col("df") > most)
    counted = elements.join(F.broadcast(often), "e", "left")
    rare = counted.where("df is null").drop("df").join(frequency.where(F.col("df") <= most), "e")
    ranked = counted.where("df is not null").unionByName(rare, allowMissingColumns=True).withColumn("at", place)
    prefix = ranked.where((F.col("df") > 1) & (F.lit(100) * (F.col("n") - F.col("at") + 1) >= F.lit(percent) * F.col("n")))
    prefix = scratch.put(prefix.join(rest.select("rep", "component"), "rep").select("e", "rep", "n", "at", "component"), "prefix")
    shares = prefix.groupBy("e", "component").agg(F.count(F.lit(1)).alias("k"))
    tops = shares.groupBy("e").agg(F.max(F.struct("k", "component")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    mixed = prefix.join(tops.select("e", F.col("top.component").alias("top")), "e")
    minor = mixed.where("component <> top").select("e", F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("at").alias("i"), F.col("component").alias("cx"))
    every = mixed.select("e", F.col("rep").alias("y"), F.col("n").alias("ny"), F.col("at").alias("j"), F.col("component").alias("cy"))
    enough = F.lit(100 + percent) * (1 + F.least(F.col("nx") - F.col("i"), F.col("ny") - F.col("j"))) >= F.lit(percent) * (F.col("nx") + F.col("ny"))
    sizes = F.lit(100) * F.least("nx", "ny") >= F.lit(percent) * F.greatest("nx", "ny")
    return _ordered(minor.join(every, "e").where((F.col("cx") != F.col("cy")) & sizes & enough), "x", "y")


def _still_mixed(members: DataFrame) -> DataFrame:
    return members.join(_mixed(members), "key")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, bands: int = 48, rows: int = 6, first_bands: int = 4, pivots: int = 2) -> DataFrame:
    """One document of each group of near-duplicates (the smallest id), with the columns it came with.

    Rows are told apart by where they are stored, not by their ids: of rows
    with one id those that are no near-duplicates of each other all stay, and
    so do all rows without words.  A row without an id counts as larger than
    all ids; of a group without ids one row stays.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    keyed, rows_of = _prepared(docs, scratch, id_col, text_col)
    found = _search(rows_of, scratch, k, percent, bands, rows, first_bands, pivots)
    first = F.struct(F.col("least").isNull().alias("none"), "least", "node")
    heads = found.placed.groupBy("group").agg(F.min(first).alias("f")).select(F.col("f.node").alias("node"))
    stay = found.classes.join(heads, "node").select(*ROW_KEY)
    gone = found.seen.where("set_id is not null").select(*ROW_KEY).join(stay, list(ROW_KEY), "left_anti")
    return keyed.join(scratch.put(gone, "gone"), list(ROW_KEY), "left_anti").select(*docs.columns)
