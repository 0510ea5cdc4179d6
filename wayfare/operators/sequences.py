"""Ordered sequences: sessions by reset, summaries, patterns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.errors import ContractViolation
from wayfare.functions import names


def _by(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def sessions(events: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "trip_no") -> DataFrame:
    """Number the runs of ``value`` that rise within a key: a row whose value is not above the one before starts a new run."""
    w = _by(keys, order)
    starts = F.when(F.col(value) <= F.lag(value).over(w), 1).otherwise(0)
    marked = events.withColumn("__start", starts)
    return marked.withColumn(out, (F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, 0)) + 1).cast("int")).drop("__start")


def summary(rows: DataFrame, keys: Sequence[str], order: Sequence[str], first: dict[str, str], last: dict[str, str], count: str = "n_stops") -> DataFrame:
    """First and last values per key by an explicit order, and the number of rows: one hash aggregation."""
    rank = F.struct(*order)
    columns = [F.min_by(c, rank).alias(out) for out, c in first.items()] + [F.max_by(c, rank).alias(out) for out, c in last.items()]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count), *columns)


def collected(rows: DataFrame, keys: Sequence[str], position: str, item: str, out: str = "sequence") -> DataFrame:
    """Items of a key in the order of their position."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(item).alias("x"))))
    return rows.groupBy(*keys).agg(F.transform(pairs, lambda s: s["x"]).alias(out))


def distinct_sequences(sequences: DataFrame, key: str, sequence: str = "sequence") -> DataFrame:
    """The different sequences of a key, sorted, and how many rows and sequences there are."""
    return sequences.groupBy(key).agg(F.array_sort(F.collect_set(sequence)).alias("sequences"), F.count(F.lit(1)).alias("n_rows"), F.countDistinct(sequence).alias("n_sequences"))


def joined_set(item: Column, separator: str = "|") -> Column:
    """The different non-null items, sorted, as text."""
    return F.array_join(F.array_sort(F.collect_set(item.cast("string"))), separator)


def collapsed(rows: DataFrame, keys: Sequence[str], order: Sequence[str], item: str) -> DataFrame:
    """Without rows whose item equals the one before."""
    w = _by(keys, order)
    return rows.withColumn("__before", F.lag(item).over(w)).where(F.col("__before").isNull() | (F.col("__before") != F.col(item))).drop("__before")


def dense_position(rows: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "position") -> DataFrame:
    return rows.withColumn(out, F.row_number().over(_by(keys, order)))


def representative(sequences: DataFrame, evidence: DataFrame, may_vary: Column, key: str = "pattern_id") -> DataFrame:
    """One stop sequence per pattern, as rows (pattern_id, seq, stop_id).

    A pattern with one sequence has it.  One with several takes the evidence's
    sequence, if its lineage allows that (``may_vary`` over the key) and the
    evidence names exactly the stops that its sequences have.
    """
    found = distinct_sequences(sequences, key).withColumn("stops", F.array_sort(F.array_distinct(F.flatten("sequences"))))
    proof = evidence.select(F.col(key), F.col("stop_ids").alias("evidence"))
    j = found.join(proof, key, "left").withColumn("varies", F.col("n_sequences") > 1)
    bad = j.where(F.col("varies") & (~may_vary | F.col("evidence").isNull() | (F.array_sort(F.array_distinct("evidence")) != F.col("stops"))))
    wrong = [r[key] for r in bad.select(key).limit(5).collect()]
    if wrong:
        raise ContractViolation(f"patterns without a single sequence or fitting evidence: {wrong}")
    chosen = F.when(F.col("varies"), F.col("evidence")).otherwise(F.col("sequences")[0])
    return j.select(key, F.posexplode(chosen).alias("i", "stop_id")).select(key, (F.col("i") + 1).cast("smallint").alias("seq"), "stop_id")


def reconstruct_trips(events: DataFrame, boundary_prefixes: Sequence[str] = (), keys: Sequence[str] = ("service_date", "vehicle_id", "pattern_id"), order: Sequence[str] = ("arr_ts", "master_seq")) -> tuple[DataFrame, DataFrame]:
    """Trips of an arrival log: (trips, the events with trip_no and trip_uid).

    A trip ends where the stop number does not rise.  A trip is partial if it
    starts after the smallest stop number of the whole log; ``partial_reason``
    is ``none``, ``boundary_clip`` (its pattern has one of the prefixes),
    ``first_service`` (a vehicle's first trip) or ``detect_gap``.
    """
    day, vehicle, pattern = (F.col(k) for k in keys)
    numbered = sessions(events, keys, order, "master_seq")
    numbered = numbered.withColumn("trip_uid", names.trip_uid(day, vehicle, pattern, F.col("trip_no")))
    lowest = events.agg(F.min("master_seq").alias("lowest"))
    named = {"route_name": "route_name"} if "route_name" in events.columns else {}
    trips = summary(numbered, ["trip_uid", *keys, "trip_no"], order, {"start_seq": "master_seq", "start_s": "arr_s", **named}, {"end_seq": "master_seq", "end_s": "arr_s"}, "n_events")
    trips = trips.crossJoin(F.broadcast(lowest))
    clipped = F.lit(False)
    for p in boundary_prefixes:
        clipped = clipped | pattern.cast("string").startswith(p)
    partial = F.col("start_seq") > F.col("lowest")
    reason = F.when(~partial, "none").when(clipped, "boundary_clip").when(F.col("trip_no") == 1, "first_service").otherwise("detect_gap")
    trips = trips.withColumns({"is_partial": partial, "partial_reason": reason, "crosses_midnight": F.col("end_s") >= 86400, "boundary_clipped": clipped})
    columns = ["trip_uid", *keys, "trip_no", *named, "n_events", "start_seq", "end_seq", "start_s", "end_s", "is_partial", "partial_reason", "crosses_midnight", "boundary_clipped"]
    return trips.select(*columns), numbered
