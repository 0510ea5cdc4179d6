"""Exact top-k inner-product search with M-trees.

Vectors of integers are lifted by one coordinate so that all have the same
length; a query, lifted by 0, is then the closer to a vector the larger their
inner product is, and metric bounds hold.  An M-tree has pages of objects.  An
entry keeps the distance to its page's routing object (the parent distance)
and, above the leaves, a routing object and a covering radius.  Search takes
pages best-first by their lower bound; ``|d(q, parent) - d(x, parent)|``, by
the triangle inequality, rules out entries before their distance is computed.

Rows are dealt to trees by metric regions: a row goes to the nearest of at most
``max_regions`` pivots, and a large region is cut into shells by distance to
its pivot.  Above the trees stand the pivots with the covering radii of their
shells, a table of bounded size that every task has.  A query first searches
the shell with the smallest lower bound; the k-th best score that it finds
there goes along to the other shells, and only to those that this score cannot
rule out by their radii or by the nearest pivot.  So what travels are queries,
once per tree that they must visit, and of each visit only results that beat
the bound come back.  Of rows with equal vectors the ``k + 1`` smallest ids
take part: no other can be in a result.

Edge cases: vectors that are null or hold a null or non-finite component take
no part, nor do rows without an id; shorter vectors, however long the others,
count as filled up with zeros; a query's own id is no candidate of it;
repeated rows count once; ties go to the smaller id; with fewer than ``k``
candidates all are returned; an empty table gives an empty result; extra
columns, whatever their names, are ignored.  Scores are exact while they are
below 2**53.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, tidy


class MTree:
    """Pages in flat arrays.  Page ``p`` holds entries ``first[p]:first[p + 1]`` of ``item``: child pages or objects."""

    FIELDS = ("vectors", "ids", "lift", "leaf", "first", "item", "route", "radius", "parent_distance")

    def __init__(self, **arrays: np.ndarray):
        for name in self.FIELDS:
            setattr(self, name, arrays[name])
        self.products = 0  # vector products computed by searches
        self.length2 = float((self.vectors[0] ** 2).sum() + self.lift[0] ** 2) if len(self.ids) else 0.0

    @classmethod
    def build(cls, vectors: np.ndarray, ids: np.ndarray, page: int = 256, length2: float | None = None) -> MTree:
        """``length2``: the squared length to which all vectors are lifted, at least the largest of theirs."""
        vectors = vectors.astype(np.float64)
        norms = (vectors**2).sum(1)
        lift = np.sqrt(np.maximum((norms.max(initial=0.0) if length2 is None else length2) - norms, 0.0))
        full = np.column_stack((vectors, lift))
        pages: list[dict] = []

        def distance(objects: np.ndarray, to: int) -> np.ndarray:
            return np.sqrt(((full[objects] - full[to]) ** 2).sum(1))

        def grow(objects: np.ndarray, route: int) -> int:
            """The page of these objects under a routing object; returns its number."""
            mine = len(pages)
            pages.append({})
            near = distance(objects, route)
            if len(objects) <= page:
                pages[mine] = {"leaf": True, "item": objects, "route": objects, "radius": np.zeros(len(objects)), "pd": near, "reach": near.max(initial=0.0)}
                return mine
            seeds = objects[np.linspace(0, len(objects) - 1, min(page, max(2, math.ceil(len(objects) / page)))).astype(int)]
            to_seed = np.column_stack([distance(objects, s) for s in seeds])
            owner = to_seed.argmin(1)
            if (owner == owner[0]).all():  # equal objects: deal them out evenly
                owner = np.arange(len(objects)) % len(seeds)
            item, routes, radius = [], [], []
            for k, s in enumerate(seeds):
                part = objects[owner == k]
                if len(part):
                    item.append(grow(part, int(s)))
                    routes.append(int(s))
                    radius.append(pages[item[-1]]["reach"])
            routes = np.array(routes)
            pages[mine] = {"leaf": False, "item": np.array(item), "route": routes, "radius": np.array(radius), "pd": distance(routes, route), "reach": near.max(initial=0.0)}
            return mine

        if len(ids):
            grow(np.arange(len(ids)), 0)
        join = lambda key, kind: np.concatenate([np.asarray(p[key]) for p in pages]).astype(kind) if pages else np.empty(0, kind)
        first = np.concatenate(([0], np.cumsum([len(p["item"]) for p in pages]))).astype(np.int64)
        leaf = np.array([p["leaf"] for p in pages], dtype=bool)
        return cls(vectors=vectors, ids=ids.astype(np.int64), lift=lift, leaf=leaf, first=first, item=join("item", np.int64), route=join("route", np.int64), radius=join("radius", np.float64), parent_distance=join("pd", np.float64))

    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.FIELDS})
        return out.getvalue()

    @classmethod
    def loads(cls, data: bytes) -> MTree:
        return cls(**np.load(io.BytesIO(data)))

    def top(self, query: np.ndarray, own_id: int, k: int, floor: float = -math.inf) -> list[tuple[float, int]]:
        """The k largest (score, id) by score, then smaller id, of scores from ``floor`` on: best-first search."""
        if not len(self.ids):
            return []
        q = query.astype(np.float64)
        base = float((q**2).sum()) + self.length2
        slack = 1e-9 * (1.0 + base)
        best: list[tuple[float, int]] = []  # heap of (score, -id), the worst first
        limit = math.inf if floor == -math.inf else math.sqrt(max(base - 2.0 * floor, 0.0) + slack)  # distance of the k-th best
        self.products += 1

        def distances(scores: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(base - 2.0 * scores, 0.0))

        root = float(distances(self.vectors[:1] @ q)[0])
        queue: list[tuple[float, int, float]] = [(0.0, 0, root)]
        while queue:
            bound, page, to_route = heapq.heappop(queue)
            if bound > limit:
                break
            span = slice(self.first[page], self.first[page + 1])
            items, routes, radius, pd = self.item[span], self.route[span], self.radius[span], self.parent_distance[span]
            if limit < math.inf:
                may = np.abs(to_route - pd) - radius <= limit
                if not may.any():
                    continue
                items, routes, radius = items[may], routes[may], radius[may]
            scores = self.vectors[routes] @ q
            self.products += len(routes)
            if self.leaf[page]:
                keep = scores >= (best[0][0] if len(best) == k else floor)
                items, scores = items[keep], scores[keep]
                for s, i in zip(scores.tolist(), self.ids[items].tolist(), strict=True):
                    if i == own_id:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heapq.heapreplace(best, (s, -i))
                if len(best) == k and best[0][0] >= floor:
                    limit = math.sqrt(max(base - 2.0 * best[0][0], 0.0) + slack)
                continue
            d = distances(scores)
            lower = np.maximum(d - radius, 0.0)
            for b, p, x in zip(lower.tolist(), items.tolist(), d.tolist(), strict=True):
                if b <= limit:
                    heapq.heappush(queue, (b, p, x))
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, floor(scale * x) as packed doubles, their squared length) of the rows whose vector is whole and finite."""
    v = F.col(vector_col)
    whole = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    good = rows.where(whole & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            values = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)) + 0.0
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            parts = np.split(values, ends[:-1]) if len(ends) else []
            norms = pa.array([float(p @ p) for p in parts], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p.tobytes() for p in parts], pa.binary()), norms], names=["id", "v", "norm"])

    return good.mapInArrow(tidy(run), "id long, v binary, norm double")


def _matrix(packed: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(packed), width))
    for row, p in zip(out, packed, strict=True):
        x = np.frombuffer(p, np.float64)
        row[: len(x)] = x
    return out


class Regions:
    """Pivots and the shells of their regions: which shell a vector belongs to, and how near to a query a shell can come."""

    SHELLS = 64

    def __init__(self, pivots: np.ndarray, length2: float, cuts: dict[int, np.ndarray] | None = None, radii: list[tuple[int, float, float]] | None = None):
        self.pivots, self.length2, self.cuts = pivots, length2, cuts or {}
        self.lift = np.sqrt(np.maximum(length2 - (pivots**2).sum(1), 0.0))
        radii = sorted(radii or [])
        self.shell = np.array([r[0] for r in radii], np.int64)
        self.low, self.high = np.array([r[1] for r in radii]), np.array([r[2] for r in radii])

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, distance) of the nearest pivot of each (lifted) vector."""
        lift = np.sqrt(np.maximum(self.length2 - (vectors**2).sum(1), 0.0))
        near = vectors @ self.pivots.T + lift[:, None] * self.lift[None, :]
        region = near.argmax(1)
        return region, np.sqrt(np.maximum(2.0 * (self.length2 - near[np.arange(len(vectors)), region]), 0.0))

    def shells(self, region: np.ndarray, distance: np.ndarray) -> np.ndarray:
        out = region.astype(np.int64) * self.SHELLS
        for r in np.unique(region).tolist():
            if r in self.cuts:
                here = region == r
                out[here] += np.searchsorted(self.cuts[r], distance[here], side="left")
        return out

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """Lower bound of the distance of a query to the rows of every shell, less a margin for rounding."""
        base = float((query**2).sum()) + self.length2
        d = np.sqrt(np.maximum(base - 2.0 * (self.pivots @ query), 0.0))
        mine = d[self.shell // self.SHELLS]
        # rows of a region are nearer to its pivot than to the query's nearest: half the difference of the two distances
        return np.maximum(np.maximum(mine - self.high, self.low - mine), (mine - d.min()) / 2) - 1e-6 * (1.0 + math.sqrt(base))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    rows: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: float = 256.0,
    tree_rows: int = 4096, block_rows: int = 1024, page_rows: int = 64, max_regions: int = 1024,
) -> DataFrame:
    """The k best rows for every row where ``is_query(id column)`` holds: query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "metric-tree")
    vectors = scratch.put(integer_vectors(rows, id_col, vector_col, scale).distinct(), "vectors")
    few = vectors.withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("nth") <= k + 1).drop("nth")
    few = scratch.put(few, "candidates")
    n, width, length2 = few.agg(F.count(F.lit(1)), F.max(F.length("v")), F.max("norm")).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = (width or 0) // 8
    asked = vectors.where(is_query(F.col("id"))).select("id", "v")
    blocks = max(1, math.ceil(asked.count() / block_rows))

    # pivots: the rows with the smallest hashes, told from the rest by a threshold before they are sorted
    wanted = min(max_regions, math.ceil(n / tree_rows))
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    below = 1 << 30 if n <= 4 * wanted else math.ceil((1 << 30) * (1.5 * wanted + 16) / n)
    chosen = few.withColumn("part", part).where(F.col("part") < below).orderBy("part", "id").limit(wanted).collect()
    regions = Regions(_matrix([r["v"] for r in chosen], width), length2)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                region, distance = regions.nearest(_matrix(part.column(1).to_pylist(), width))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(region, pa.int64()), pa.array(distance, pa.float64())], names=["id", "v", "region", "distance"])

    placed = scratch.put(few.select("id", "v").mapInArrow(tidy(assign), "id long, v binary, region long, distance double"), "placed")
    sizes = {r["region"]: r["n"] for r in placed.groupBy("region").agg(F.count(F.lit(1)).alias("n")).collect()}
    shells = {r: min(Regions.SHELLS, math.ceil(c / tree_rows)) for r, c in sizes.items()}
    large = [r for r, c in shells.items() if c > 1]
    if large:
        steps = [i / Regions.SHELLS for i in range(1, Regions.SHELLS)]
        found = placed.where(F.col("region").isin(large)).groupBy("region").agg(F.percentile_approx("distance", steps, 1000).alias("q")).collect()
        regions.cuts = {r["region"]: np.unique([r["q"][round(i * Regions.SHELLS / shells[r["region"]]) - 1] for i in range(1, shells[r["region"]])]) for r in found}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shell = regions.shells(batch.column(2).to_numpy(), batch.column(3).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shell, pa.int64())], names=["id", "v", "region", "distance", "shell"])

    dealt = placed.mapInArrow(tidy(deal), "id long, v binary, region long, distance double, shell long")
    dealt = scratch.put(dealt, "dealt")
    radii = dealt.groupBy("shell").agg(F.min("distance").alias("low"), F.max("distance").alias("high"), F.count(F.lit(1)).alias("n")).collect()
    regions = Regions(regions.pivots, length2, regions.cuts, [(r["shell"], r["low"], r["high"]) for r in radii])
    # shells with more rows than a tree holds (equal distances, very many rows) are dealt to several trees by hash
    parts = F.create_map(*[F.lit(x) for r in radii if r["n"] > 2 * tree_rows for x in (r["shell"], math.ceil(r["n"] / tree_rows))] or [F.lit(-1).cast("long"), F.lit(1)])
    tree = F.pmod(F.xxhash64("id"), F.coalesce(F.element_at(parts, F.col("shell")), F.lit(1)))

    def plant(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        tree = MTree.build(_matrix(table["v"].to_pylist(), width), table["id"].to_numpy(), page_rows, length2)
        return pa.table({"shell": [key[0].as_py()], "pages": [tree.dumps()]}, schema=pa.schema([("shell", pa.int64()), ("pages", pa.binary())]))

    planted = scratch.put(dealt.select("shell", tree.alias("part"), "id", "v").groupBy("shell", "part").applyInArrow(plant, "shell long, pages binary"), "trees")

    def visits(home: bool):
        """(id, v, score of the k-th best so far) -> the shells that the query searches: its home shell, or all others that may hold better rows."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    row, shell = [], []
                    for i, (q, floor) in enumerate(zip(_matrix(part.column(1).to_pylist(), width), part.column(2).to_pylist(), strict=True)):
                        bounds = regions.bounds(q)
                        first = int(bounds.argmin())
                        if home:
                            shell.append(regions.shell[[first]])
                        else:
                            limit = math.inf if floor is None else math.sqrt(max(float((q**2).sum()) + length2 - 2.0 * floor, 0.0))
                            may = bounds <= limit
                            may[first] = False
                            shell.append(regions.shell[may])
                        row.append(np.full(len(shell[-1]), i))
                    taken = part.take(pa.array(np.concatenate(row)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shell), pa.int64()), *taken.columns], names=["shell", "id", "v", "floor"])

        return tidy(run)

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        floor = np.array([-np.inf if x is None else x for x in table["floor"].to_pylist()])
        data = np.column_stack((table["id"].to_numpy().astype(np.int64).view(np.float64), floor, _matrix(table["v"].to_pylist(), width)))
        return pa.table({"shell": [key[0].as_py()], "queries": [data.tobytes()]}, schema=pa.schema([("shell", pa.int64()), ("queries", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pages, queries in zip(batch.column(0), batch.column(1), strict=True):
                tree = MTree.loads(pages.as_py())
                data = np.frombuffer(queries.as_py(), np.float64).reshape(-1, width + 2)
                ids, out = np.ascontiguousarray(data[:, 0]).view(np.int64), ([], [], [])
                for q, floor, own in zip(data[:, 2:], data[:, 1].tolist(), ids.tolist(), strict=True):
                    for s, i in tree.top(q, own, k, floor):
                        out[0].append(own)
                        out[1].append(i)
                        out[2].append(int(s))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])

    def searched(queries: DataFrame, home: bool) -> DataFrame:
        go = queries.mapInArrow(visits(home), "shell long, id long, v binary, floor double")
        block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).alias("block")
        gathered = go.select("*", block).groupBy("shell", "block").applyInArrow(gather, "shell long, queries binary")
        # a tree travels once, whatever the number of its blocks of queries
        pairs = gathered.join(planted, "shell").select("pages", "queries")
        return pairs.mapInArrow(tidy(run), "query_id long, vec_id long, score long")

    first = scratch.put(_best(searched(asked.withColumn("floor", F.lit(None).cast("double")), True), k).drop("rank"), "home")
    floors = first.groupBy("query_id").agg(F.min("score").cast("double").alias("floor"), F.count(F.lit(1)).alias("found")).where(F.col("found") == k)
    others = searched(asked.join(floors.select(F.col("query_id").alias("id"), "floor"), "id", "left").select("id", "v", "floor"), False)
    return _best(first.unionByName(others), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
