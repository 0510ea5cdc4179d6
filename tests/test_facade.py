"""The short way in."""

import collections
import itertools
import json

from pyspark.sql import functions as F

from wayfare.plans import facade, fixtures, stages

SF = "/root/testdata/sf0.001"


def test_two_tables_to_hubs(spark, tmp_path):
    stops, times = fixtures.stops(spark, SF), fixtures.route_stops(spark, SF)
    hubs = facade.hub_table(stops, times).cache()
    place = {r["stop_id"]: r["place_id"] for r in fixtures.members(spark, SF).collect()}
    routes, near = collections.defaultdict(list), collections.defaultdict(set)
    for r in times.orderBy("pattern_id", "seq").collect():
        routes[r["pattern_id"]].append(place[r["stop_id"]])
    for at in routes.values():
        for x, y in itertools.pairwise(at):
            if x != y:
                near[x].add(y)
                near[y].add(x)
    assert hubs.count() == len(set(place.values())) and {r["place_id"]: r["D"] for r in hubs.where("D > 0").collect()} == {p: len(q) for p, q in near.items()}
    assert hubs.where("D > 0").count() < hubs.count()
    assert hubs.agg(F.min("rank_degree")).first()[0] == 1
    facade.write_geojson(hubs.where("D >= 3"), str(tmp_path / "h.json"))
    found = json.loads((tmp_path / "h.json").read_text())
    assert len(found["features"]) == sum(len(q) >= 3 for q in near.values()) and found["features"][0]["geometry"]["type"] == "Point"
    official = hubs.orderBy(F.desc("L"), F.desc("D"), "place_id").limit(3).select(F.col("lat_centroid").alias("lat"), F.col("lon_centroid").alias("lon"))
    assert stages.precision_near(hubs, official, 3) == 1.0


def test_similar_names_are_grouped(spark):
    rows = [("a", "City Hall", 0.0), ("b", "City  Hall", 0.0002), ("c", "Harbour", 0.0001), ("d", "City Hall", 0.01)]
    s = spark.createDataFrame(rows, "stop_id string, stop_name string, y double").select("stop_id", "stop_name", (F.lit(35.0) + F.col("y")).alias("lat"), F.lit(129.0).alias("lon"))
    assert {r["stop_id"]: r["label"] for r in facade.group_similar(s).collect()} == {"a": "a", "b": "a", "c": "c", "d": "d"}
