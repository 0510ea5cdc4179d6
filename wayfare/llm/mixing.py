"""Mixing sources to target weights by a low-discrepancy schedule.

Every source is a cyclic stream of words: its documents in an order shuffled
by a hash of the id.  The stream is cut into blocks of equally many words.
Slot ``n`` of the mix has the golden-ratio point ``frac(n * phi)``; mapped
through the cumulative target weights it names a source, and the slots of a
source are ranked: rank ``k`` takes block ``k`` of that source's stream.  So
each prefix of the schedule holds the sources close to their weights.

All of it is DataFrame code.  No window spans a whole source: running word
counts go by hash range (bounded groups) with offsets from a small table of
range sums, and slot ranks go by fixed chunks of the schedule in the same way.

Edge cases: null or empty texts have size 0 and are never taken; a null source
is a source of its own, last in order; null ids are shuffled as the empty text;
repeated rows and rows that share an id are documents of their own; very long
texts are counted whole and stand in as many blocks as they fill; an empty
table gives an empty result; extra columns, whatever their names, are ignored
by the query and kept by :func:`mixed_documents`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ROW_KEY, Scratch, with_row_key, word_count

GOLDEN = 0.6180339887498949
#: Cells of the unit interval by which slots find their source with an equi-join.
CELLS = 4096
#: Slots in a chunk of the schedule.
CHUNK = 65536


def source_targets(sums: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(src_key, source, source_size) -> the same with ``weight`` and ``target``.

    Sources by code point, null last, take the weights in turn and divide
    ``share`` times all words.  A target stops at ``most`` times its source;
    the rest is shared again by weight until none is above, computed in closed
    form: with sources by cap/weight, the water level is the first
    (total - caps before) / (weights left) not above its own cap/weight.
    One row per source goes through one task, rows of documents never do.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    s = sums.withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    s = s.withColumn("cap", F.lit(float(most)) * F.col("source_size")).withColumn("level_at", F.col("cap") / F.col("weight"))
    order = Window.orderBy(F.col("level_at"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn(
        "try_level",
        (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("weight").over(after),
    )
    level = F.first(F.when(F.col("try_level") <= F.col("level_at"), F.col("try_level")), ignorenulls=True).over(everything)
    s = s.withColumn("level", F.coalesce(level, F.lit(0.0)))
    return s.withColumn("target", F.least(F.col("cap"), F.col("level") * F.col("weight"))).select("src_key", "source", "source_size", "weight", "target")


def schedule(targets: DataFrame, slots: int, block_words: int) -> DataFrame:
    """(src_key, target) -> the slots of the mix: (slot, src_key, rank).

    A source has ceil(floor(target) / block_words) slots.  Golden-ratio points
    that a source gets beyond these are left out; where the points give it too
    few, the missing ranks follow at the end of the schedule.
    """
    spark = targets.sparkSession
    order = Window.orderBy("src_key").rowsBetween(Window.unboundedPreceding, 0)
    total = Window.orderBy("src_key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = targets.select("src_key", "need").where("need > 0")
    t = t.withColumn("hi", F.sum("need").over(order) / F.sum("need").over(total)).withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("src_key")), F.lit(0.0)))
    cells = t.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1)))))
    points = spark.range(0, max(slots, 0)).select(F.col("id").alias("slot"), (F.col("id") * F.lit(GOLDEN) - F.floor(F.col("id") * F.lit(GOLDEN))).alias("x"))
    points = points.withColumn("cell", F.floor(F.col("x") * CELLS)).withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    hit = points.join(cells, "cell").where("x >= lo and x < hi").select("slot", "chunk", "src_key", "need")
    per_chunk = hit.groupBy("src_key", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("src_key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.select("src_key", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("chunk", "src_key").orderBy("slot")
    ranked = hit.withColumn("r", F.row_number().over(inside) - 1).join(offsets, ["src_key", "chunk"])
    ranked = ranked.withColumn("rank", F.col("first") + F.col("r")).where("rank < need").select("slot", "src_key", "rank")
    reached = per_chunk.groupBy("src_key").agg(F.sum("n").alias("had"))
    short = t.join(reached, "src_key", "left").withColumn("had", F.coalesce("had", F.lit(0))).where("had < need")
    tail = short.select("src_key", F.explode(F.sequence(F.col("had"), F.col("need") - 1)).alias("rank"))
    tail = tail.select((F.lit(slots) + F.col("rank")).alias("slot"), "src_key", "rank")
    return ranked.unionByName(tail)


def mix(
    docs: DataFrame, id_col: str = "doc_id", weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, block_words: int = 1024, range_rows: int = 2_000
) -> tuple[DataFrame, DataFrame]:
    """Mix ``docs`` (row key, ``id_col``, source, text).

    Returns ``(rows, pieces)``, both with the row key.  rows: one per document
    with ``doc_id, source, size, source_size, target, start`` (its place in the
    source's stream).  pieces: what the mix takes, one row per document, epoch
    and block: ``src_key, epoch, slot, at`` (place in the block), ``words``.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    sized = docs.select(*ROW_KEY, F.col(id_col).alias("doc_id"), F.col("source").cast("string").alias("source"), word_count().alias("size"))
    sized = sized.withColumn("src_key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")))
    sized = sized.withColumn("shuffle_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    sized = scratch.put(sized, "sized")
    n = sized.count()
    ranges = max(1, math.ceil(n / range_rows))
    sized = sized.withColumn("range", F.floor(F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("long") * ranges / F.lit(2**32)))
    sums = sized.groupBy("src_key", "source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sums, weights, share, most)
    targets = targets.withColumn("limit", F.floor(F.col("target"))).withColumn("need", F.ceil(F.col("limit") / F.lit(block_words)))
    targets = scratch.put(targets, "targets")
    slots = targets.agg(F.sum("need")).first()[0] or 0

    by_range = sized.groupBy("src_key", "range").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("src_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_range.select("src_key", "range", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("first"))
    running = Window.partitionBy("src_key", "range").orderBy("shuffle_key", "doc_id", "size", *ROW_KEY).rowsBetween(Window.unboundedPreceding, 0)
    rows = sized.withColumn("upto", F.sum("size").over(running)).join(offsets, ["src_key", "range"])
    rows = rows.withColumn("start", F.col("first") + F.col("upto") - F.col("size")).drop("first", "upto", "range", "shuffle_key", "source")
    rows = rows.join(targets, "src_key")
    rows = scratch.put(rows.select(*ROW_KEY, "src_key", "source", "doc_id", "size", "source_size", "target", "limit", "start"), "rows")

    taken = rows.where("size > 0").withColumn("epoch", F.explode(F.array(F.lit(0), F.lit(1))))
    taken = taken.withColumn("from", F.col("start") + F.col("epoch") * F.col("source_size"))
    taken = taken.withColumn("to", F.least(F.col("from") + F.col("size"), F.col("limit"))).where("from < to")
    taken = taken.withColumn("rank", F.explode(F.sequence(F.floor(F.col("from") / block_words), F.floor((F.col("to") - 1) / block_words))))
    begin, end = F.greatest(F.col("from"), F.col("rank") * block_words), F.least(F.col("to"), (F.col("rank") + 1) * block_words)
    taken = taken.withColumn("at", begin - F.col("rank") * block_words).withColumn("words", end - begin)
    plan = schedule(targets, slots, block_words)
    pieces = taken.select(*ROW_KEY, "src_key", "epoch", "rank", "at", "words").join(plan, ["src_key", "rank"])
    return rows, pieces


def taken_words(docs: DataFrame, **params) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words) and slot (the first of the mix that has any of them, else null)."""
    rows, pieces = mix(with_row_key(docs, Scratch(docs.sparkSession, "mixing-rows")), **params)
    took = pieces.groupBy(*ROW_KEY).agg(F.sum("words").alias("taken"), F.min("slot").alias("slot"))
    out = rows.join(took, list(ROW_KEY), "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.col("slot").cast("long").alias("slot"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **params) -> DataFrame:
    """The documents of the mix in the order of its slots: a row of ``docs`` once per epoch that takes any of its words.

    A copy stands where its first word does, in the slot of that word's block.
    A document that the end of its source's share cuts is kept whole.  Rows are
    told apart by where they are stored, so rows with one id, or none, are
    documents of their own, and columns of any name come back untouched.
    """
    keyed = with_row_key(docs, Scratch(docs.sparkSession, "mixing-rows"))
    _, pieces = mix(keyed, id_col=id_col, **params)
    place = F.min(F.struct("slot", "at"))
    copies = pieces.groupBy(*ROW_KEY, "epoch").agg(place.alias("__place")).drop("epoch")
    placed = keyed.join(copies, list(ROW_KEY))
    order = ("__place.slot", "__place.at", *ROW_KEY)
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)
