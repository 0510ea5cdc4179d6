"""A short way in: two tables to a ranked hub table.

These functions are documented wishes around the pipeline rather than part of
it; they reuse its operators with their parameters.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare import config
from wayfare.functions import names
from wayfare.operators import joins, network, places
from wayfare.operators.components import connected_components
from wayfare.sources.scratch import Scratch


def group_similar(stops: DataFrame, max_m: float = 40.0, similarity: float = 0.85, prefix: str = "PB") -> DataFrame:
    """Places by closeness and similar names: stops within ``max_m`` whose names differ in at most a share of
    1 - ``similarity`` of their letters are linked.  Columns as of ``places.cluster``."""
    s = places.named(stops)
    near = joins.radius_pairs(s, max_m, "stop_id")
    name = lambda k: s.select(F.col("stop_id").alias(k), F.col("name_norm").alias(f"n{k}"))
    pairs = near.join(name("a"), "a").join(name("b"), "b")
    alike = 1 - F.levenshtein("na", "nb") / F.greatest(F.length("na"), F.length("nb"), F.lit(1))
    linked = connected_components(pairs.where(alike >= similarity)).select(F.col("node").alias("stop_id"), F.col("component").alias("label"))
    out = s.join(linked, "stop_id", "left").withColumn("label", F.coalesce("label", "stop_id"))
    first = F.first("name_norm").over(Window.partitionBy("label").orderBy("stop_id"))
    out = out.withColumn("name_norm", first)
    return out.withColumn("place_id", names.place_id(prefix, F.col("name_norm"), F.col("label"))).select("stop_id", "name_norm", "label", "place_id", "lat", "lon")


def hub_table(stops: DataFrame, stop_times: DataFrame, similar: bool = False, params: dict | None = None) -> DataFrame:
    """Stops (stop_id, stop_name, lat, lon) and stop times (route, pattern_id, seq, stop_id) to hubs with ranks."""
    p = params or config.load()
    h = p["hubs"]
    members = group_similar(stops) if similar else places.cluster(places.named(stops), p["places"]["linkage_m"])
    scratch = Scratch(stops.sparkSession, "facade")
    table, mapped = (scratch.put(df, name) for df, name in zip(places.geometry(members.drop("stop_name")), ("places", "map"), strict=True))
    edges = scratch.put(network.edges(network.place_steps(stop_times, mapped), table), "edges")
    degrees = network.degree(edges, table)
    arms = network.arms(network.bearings(edges, table), table, [h["arm_degrees"]]).toDF("place_id", "A")
    life = network.lifetimes(network.first_violations(edges, h["k_max"]), degrees, h["mask"], h["dominance"], h["k_max"])
    metrics = network.metrics(degrees, arms, life, table, h["gate_degree"])
    classes = network.qualify(metrics, h["thresholds"]).select("place_id", "hub_class")
    ranked = network.ranked(metrics).drop("name_norm")
    return table.join(ranked, "place_id").join(classes, "place_id")


def geojson(hubs: DataFrame) -> DataFrame:
    """One GeoJSON feature per hub row, as text in column ``feature``."""
    properties = [c for c in hubs.columns if c not in ("lat_centroid", "lon_centroid")]
    point = F.struct(F.lit("Point").alias("type"), F.array("lon_centroid", "lat_centroid").alias("coordinates"))
    return hubs.select(F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*properties).alias("properties"))).alias("feature"))


def write_geojson(hubs: DataFrame, path: str, most: int = 100_000) -> None:
    """A feature collection as one file, for a bounded number of hubs."""
    rows = geojson(hubs).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} hubs; write geojson(hubs) as text instead")
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"type": "FeatureCollection", "features": [json.loads(r["feature"]) for r in rows]}, f, ensure_ascii=False)
