"""Places: clusters of stops with one name, their geometry, diagnostics and overrides."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.errors import ContractViolation
from wayfare.functions import geo, names
from wayfare.operators import joins
from wayfare.operators.components import connected_components

OVERRIDE_COLUMNS = ["action", "place_a", "place_b", "reason", "source"]


def named(stops: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    return stops.withColumn("name_norm", names.stop_name(F.col("stop_name"), aliases))


def cluster(stops: DataFrame, linkage_m: float = 150.0, prefix: str = "PB") -> DataFrame:
    """Single linkage inside names: (stop_id, name_norm, label, place_id, lat, lon).

    Stops of one name within ``linkage_m`` are linked; a cluster's label is its
    smallest stop id.  ``stops`` has stop_id, name_norm, lat, lon.
    """
    edges = joins.radius_pairs(stops, linkage_m, "stop_id", block="name_norm")
    linked = connected_components(edges).select(F.col("node").alias("stop_id"), F.col("component").alias("label"))
    out = stops.join(linked, "stop_id", "left").withColumn("label", F.coalesce("label", "stop_id"))
    return out.withColumn("place_id", names.place_id(prefix, F.col("name_norm"), F.col("label"))).select("stop_id", "name_norm", "label", "place_id", "lat", "lon", *([c for c in ("stop_name",) if c in stops.columns]))


def geometry(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(places, stop map) of (stop_id, name_norm, place_id, lat, lon[, place_name, is_override_merged])."""
    title = F.col("place_name") if "place_name" in members.columns else F.col("name_norm")
    merged = F.max("is_override_merged") if "is_override_merged" in members.columns else F.lit(False)
    places = members.groupBy("place_id").agg(
        F.min(title).alias("place_name"),
        F.min(title).alias("name_norm"),
        F.count(F.lit(1)).cast("int").alias("n_stops"),
        F.countDistinct("name_norm").cast("int").alias("n_names"),
        F.round(F.avg("lat"), 6).alias("lat_centroid"),
        F.round(F.avg("lon"), 6).alias("lon_centroid"),
        merged.alias("is_override_merged"),
    )
    places = places.join(diameters(members), "place_id", "left").withColumn("span_m", F.coalesce("span_m", F.lit(0.0)))
    centre = places.select("place_id", "lat_centroid", "lon_centroid")
    d = geo.haversine(F.col("lat"), F.col("lon"), F.col("lat_centroid"), F.col("lon_centroid"))
    mapped = members.join(centre, "place_id").select("stop_id", "place_id", "name_norm", d.alias("dist_to_centroid_m"))
    return places.select("place_id", "place_name", "name_norm", "n_stops", "n_names", "lat_centroid", "lon_centroid", "span_m", "is_override_merged"), mapped


def diameters(members: DataFrame) -> DataFrame:
    """Largest distance between two stops of a place: (place_id, span_m), 0 for one stop.

    The stop farthest from a first one, and the stop farthest from that, give a
    lower bound b of the diameter.  With r the distance to the first stop and R
    the largest r, both ends of the diameter have r >= b - R, so only these
    stops meet each other: of a round place its rim, not its pairs.
    """
    at = lambda y, x: geo.haversine(F.col("lat"), F.col("lon"), F.col(y), F.col(x))
    point = F.struct("lat", "lon")
    first = members.groupBy("place_id").agg(F.min_by(point, F.struct("stop_id")).alias("o"), F.count(F.lit(1)).alias("n"))
    near = members.join(first.where("n > 1").select("place_id", F.col("o.lat").alias("y0"), F.col("o.lon").alias("x0")), "place_id")
    near = near.select("place_id", "stop_id", "lat", "lon", at("y0", "x0").alias("r"))
    far = near.groupBy("place_id").agg(F.max("r").alias("most"), F.max_by(point, F.struct("r", "stop_id")).alias("f"))
    near = near.join(far.select("place_id", "most", F.col("f.lat").alias("y1"), F.col("f.lon").alias("x1")), "place_id").withColumn("d", at("y1", "x1"))
    bound = near.groupBy("place_id").agg(F.max("d").alias("bound"))
    ends = near.join(bound, "place_id").where(F.col("r") >= F.col("bound") - F.col("most") - 1e-3)
    span = joins.block_pairs(ends, "place_id", "stop_id").groupBy("place_id").agg(F.max("dist_m").alias("span_m"))
    return first.select("place_id").join(span, "place_id", "left").select("place_id", F.coalesce("span_m", F.lit(0.0)).alias("span_m"))


def validity(members: DataFrame, linkage_m: float = 150.0) -> DataFrame:
    """One row (n_places, n_split, n_too_close): places that are not connected by themselves, and pairs of places of one name within the limit."""
    again = cluster(members.select("stop_id", F.col("place_id").alias("name_norm"), "lat", "lon"), linkage_m)
    split = again.groupBy("name_norm").agg(F.min("label").alias("a"), F.max("label").alias("b")).agg(F.count(F.lit(1)).alias("n_places"), F.count_if(F.col("a") != F.col("b")).alias("n_split"))
    owner = members.select("stop_id", "place_id")
    near = joins.radius_pairs(members, linkage_m, "stop_id", block="name_norm")
    near = near.join(owner.withColumnsRenamed({"stop_id": "a", "place_id": "pa"}), "a").join(owner.withColumnsRenamed({"stop_id": "b", "place_id": "pb"}), "b")
    close = near.where("pa <> pb").select(F.least("pa", "pb").alias("x"), F.greatest("pa", "pb").alias("y")).distinct().agg(F.count(F.lit(1)).alias("n_too_close"))
    return split.crossJoin(F.broadcast(close))


def _gaps(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """Smallest distance between members of two places: (place_a, place_b, gap_m)."""
    a = members.select(F.col("place_id").alias("place_a"), F.col("lat").alias("ya"), F.col("lon").alias("xa"))
    b = members.select(F.col("place_id").alias("place_b"), F.col("lat").alias("yb"), F.col("lon").alias("xb"))
    all_pairs = pairs.select("place_a", "place_b").join(a, "place_a").join(b, "place_b")
    d = geo.haversine(F.col("ya"), F.col("xa"), F.col("yb"), F.col("xb"))
    return all_pairs.groupBy("place_a", "place_b").agg(F.min(d).alias("gap_m"))


def under_merged(members: DataFrame, max_gap_m: float | None = None) -> DataFrame:
    """Pairs of places with one name: the gap between their nearest stops and the number of places of that name."""
    p = members.select("name_norm", "place_id").distinct()
    n = p.groupBy("name_norm").agg(F.count(F.lit(1)).alias("n_clusters_of_name"))
    pairs = p.select("name_norm", F.col("place_id").alias("place_a")).join(p.select("name_norm", F.col("place_id").alias("place_b")), "name_norm").where("place_a < place_b")
    out = pairs.join(_gaps(members, pairs), ["place_a", "place_b"]).join(n, "name_norm")
    out = out.select("name_norm", F.col("place_a").alias("place_id_a"), F.col("place_b").alias("place_id_b"), F.round("gap_m", 3).alias("gap_m"), "n_clusters_of_name")
    return out if max_gap_m is None else out.where(F.col("gap_m") <= max_gap_m)


def alias_candidates(members: DataFrame, places: DataFrame, max_m: float = 30.0) -> DataFrame:
    """Pairs of places with different names whose nearest stops are within ``max_m``, with both gaps."""
    near = joins.radius_pairs(members, max_m, "stop_id")
    owner = members.select("stop_id", "place_id", "name_norm")
    a = owner.select(F.col("stop_id").alias("a"), F.struct(F.col("place_id").alias("p"), F.col("name_norm").alias("n")).alias("x"))
    b = owner.select(F.col("stop_id").alias("b"), F.struct(F.col("place_id").alias("p"), F.col("name_norm").alias("n")).alias("y"))
    j = near.join(a, "a").join(b, "b").where("x.n <> y.n").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "dist_m")
    g = j.groupBy("x", "y").agg(F.min("dist_m").alias("gap")).select(F.col("x.p").alias("place_id_a"), F.col("y.p").alias("place_id_b"), F.col("x.n").alias("name_a"), F.col("y.n").alias("name_b"), "gap")
    at = lambda s: places.select(F.col("place_id").alias(f"place_id_{s}"), F.col("lat_centroid").alias(f"lat_{s}"), F.col("lon_centroid").alias(f"lon_{s}"))
    g = g.join(at("a"), "place_id_a").join(at("b"), "place_id_b")
    centroid = geo.haversine(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"))
    return g.select("place_id_a", "place_id_b", "name_a", "name_b", F.round("gap", 3).alias("gap_m"), F.round(centroid, 3).alias("centroid_gap_m"))


def apply_overrides(members: DataFrame, overrides: Sequence[dict], prefix: str = "PB") -> tuple[DataFrame, list[dict]]:
    """Merge places by hand, in order: (members with place_id, place_name, is_override_merged; one audit row per override).

    Each row names places as they are at that row: ``merge`` puts b into a,
    and the new id comes from a's name and the smallest stop of both.  The list
    is short and ordered, so it is folded on the driver over the places that it
    touches, and the resulting id map is joined.
    """
    plain = members.withColumn("place_name", F.col("name_norm")).withColumn("is_override_merged", F.lit(False))
    if not overrides:
        return plain, []
    touched = sorted({o[k] for o in overrides for k in ("place_a", "place_b")})
    rows = members.where(F.col("place_id").isin(touched)).groupBy("place_id").agg(F.min("name_norm").alias("name"), F.min("stop_id").alias("least"), F.count(F.lit(1)).alias("n"))
    now = {r["place_id"]: (r["name"], r["least"], r["n"], [r["place_id"]]) for r in rows.collect()}
    audit = []
    for number, o in enumerate(overrides, 1):
        a, b = o["place_a"], o["place_b"]
        if o["action"] != "merge":
            raise ContractViolation(f"override {number}: unknown action {o['action']!r}")
        if a == b:
            raise ContractViolation(f"override {number} merges {a} with itself")
        for p in (a, b):
            if p not in now:
                raise ContractViolation(f"override {number} refers to {p}, which is not there")
        (name, least_a, n_a, from_a), (_, least_b, n_b, from_b) = now.pop(a), now.pop(b)
        least = min(least_a, least_b)
        new = f"{prefix}_{hashlib.sha1(f'{name}|{least}'.encode()).hexdigest()[:8]}"
        now[new] = (name, least, n_a + n_b, from_a + from_b)
        audit.append({"row_no": number, "action": "merge", "place_a": a, "place_b": b, "result_place_id": new, "n_stops_merged": n_a + n_b, "reason": o.get("reason"), "source": o.get("source")})
    renamed = [(old, new, name) for new, (name, _, _, olds) in now.items() if len(olds) > 1 for old in olds]
    table = F.broadcast(members.sparkSession.createDataFrame(renamed, "place_id string, new_id string, new_name string"))
    out = plain.join(table, "place_id", "left").withColumns({"place_id": F.coalesce("new_id", "place_id"), "place_name": F.coalesce("new_name", "place_name"), "is_override_merged": F.col("new_id").isNotNull()})
    return out.drop("new_id", "new_name"), audit
