"""The four stages as functions from tables to tables.

``planned`` is a timetable with trip ids; ``actual`` is one day's arrival log
whose trips are reconstructed.  Every function takes a dictionary of input
tables and returns a dictionary of output tables; nothing is written here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare import config
from wayfare.errors import ContractViolation
from wayfare.functions import geo, names, times
from wayfare.operators import canonical, joins, network, places, sequences
from wayfare.sources.scratch import Scratch

Tables = dict[str, DataFrame]


def ingest_planned(raw: Tables, params: dict, aliases: dict[str, str] | None = None) -> Tables:
    """schedule, stops, routes, tags (validated raw tables) -> stop_times, trips, stops, route_union, variant_tags."""
    t = params["time"]
    clock = lambda c: times.hms24(F.col(c), True, t["first_hour"], t["last_hour"])
    s = raw["schedule"]
    stop_times = s.select("trip_id", F.col("route_id").alias("pattern_id"), "route_name", "stop_id", F.col("stop_sequence").cast("smallint").alias("seq"), clock("arrival_time").alias("arr_s"), clock("departure_time").alias("dep_s"), names.lineage(F.col("route_id")).alias("lineage"))
    trips = sequences.summary(stop_times, ["trip_id", "pattern_id", "lineage"], ["seq"], {"start_s": "arr_s"}, {"end_s": "arr_s"})
    stops = raw["stops"].select("stop_id", "stop_name", F.col("stop_lat").cast("double").alias("lat"), F.col("stop_lon").cast("double").alias("lon"), names.lineage(F.col("stop_id")).alias("lineage"))
    stops = canonical.membership(stops, stop_times)
    listed = raw["routes"].withColumn("__row", F.struct("노선명", "정류장순서"))
    listed = listed.withColumns({"lat": F.col("위도").cast("double"), "lon": F.col("경도").cast("double")})
    found, failures = joins.nearest_in_block(listed, stops, "__row", "정류장명", "lat", "lon", params["resolve"]["max_dist_m"], aliases)
    seconds = lambda c: times.time_list(F.col(c), times.spelled_clock, None, 0, 48)
    union = listed.join(found, "__row", "left").select(F.col("노선명").alias("route_name"), F.col("정류장순서").cast("smallint").alias("seq"), F.col("원본순서").cast("smallint").alias("원본순서"), "stop_id", F.col("도착횟수").cast("int").alias("도착횟수"), seconds("도착시간들").alias("arr_list_s"), seconds("출발시간들").alias("dep_list_s"))
    return {
        "stop_times": stop_times,
        "trips": trips.select("trip_id", "pattern_id", F.col("n_stops").cast("smallint").alias("n_stops"), "start_s", "end_s", "lineage"),
        "stops": stops,
        "route_union": union,
        "variant_tags": raw["tags"],
        "join_failures": failures.select(F.col("__row.노선명").alias("route_name"), F.col("__row.정류장순서").alias("seq"), "reason", "dist_m"),
        "join_resolved": found.select("stop_id", "dist_m", "via_alias"),
    }


def ingest_actual(raw: Tables, params: dict) -> Tables:
    """events, stops, routes (validated raw tables) -> events, route_master, stops, route_agg."""
    t = params["time"]
    e = raw["events"]
    day = F.to_date(F.col("운행 일자"), "yyyyMMdd")
    arr, dep = times.twelve_hour(F.col("arrival_time")), times.twelve_hour(F.col("departure_time"))
    service = lambda x: times.service_seconds(x, day, t["first_hour"], t["last_hour"])
    events = e.select(
        F.col("OBE_ID").alias("obe_id"), F.col("route_id").alias("pattern_id"), "route_name", F.col("버스정류장 순번").cast("smallint").alias("master_seq"), "stop_id", arr.alias("arr_ts"), service(arr).alias("arr_s"), service(dep).alias("dep_s"),
        times.is_no_departure(F.col("departure_time")).alias("dep_is_sentinel"), F.col("위도").cast("double").alias("lat"), F.col("경도").cast("double").alias("lon"), F.col("권역").alias("zone"), F.col("행정동").alias("admin_dong"), "stop_id_raw", F.col("운행 일자").alias("service_date"),
    )
    agg = raw["routes"].select(
        F.col("route_id").alias("pattern_id"), "route_name", F.col("stop_sequence").cast("smallint").alias("seq"), "stop_id", "stop_name", F.round(F.col("stop_lat").cast("double"), 6).alias("lat"), F.round(F.col("stop_lon").cast("double"), 6).alias("lon"), F.col("권역").alias("zone"), F.col("행정동").alias("admin_dong"),
        F.col("도착횟수").cast("int").alias("도착횟수"), times.time_list(F.col("도착시간들"), times.clock_token, t["wrap_below_hour"] * 3600, t["first_hour"], t["last_hour"]).alias("arr_list_s"), F.lit(True).alias("derived_from_schedule"),
    )
    stops = raw["stops"].select("stop_id", "stop_name", F.round(F.col("stop_lat").cast("double"), 6).alias("lat"), F.round(F.col("stop_lon").cast("double"), 6).alias("lon"), "zone", "admin_dong")
    return {"events": events, "route_master": events.select("pattern_id", "master_seq", "stop_id").distinct(), "stops": stops, "route_agg": agg}


def support_token(rules: dict) -> str:
    """The text that marks support runs, from the rule of that class."""
    found = [r["rule"].split(":", 1)[1] for r in rules["rules"] if r["class"] == "support" and r["rule"].startswith("contains:")]
    if len(found) != 1:
        raise KeyError("the rules need one contains-rule of class support")
    return found[0]


def canonical_planned(tables: Tables, params: dict, rules: dict, check_counts: bool = True) -> Tables:
    """stop_times, trips, stops, route_union, variant_tags, evidence -> patterns and what follows from them."""
    c, token = params["canonical"], support_token(rules)
    st = tables["stop_times"]
    per_trip = sequences.collected(st, ["trip_id", "pattern_id", "lineage"], "seq", "stop_id")
    varies = sequences.distinct_sequences(per_trip, "pattern_id").select("pattern_id", (F.col("n_sequences") > 1).alias("is_drt"))
    lineage = F.col("pattern_id").startswith("BR_ACC0_")
    pattern_stops = sequences.representative(per_trip, tables["evidence"], lineage)
    keyed = sequences.collected(pattern_stops, ["pattern_id"], "seq", "stop_id").select("pattern_id", names.sequence_key(F.col("sequence")).alias("pattern_key"), F.size("sequence").cast("smallint").alias("n_stops"))
    core = st.groupBy("pattern_id").agg(F.min("route_name").alias("route_name"), F.min("lineage").alias("lineage"), F.countDistinct("trip_id").alias("n_trips"))
    core = core.join(keyed, "pattern_id").join(varies, "pattern_id").withColumn("route", names.base_name(F.col("route_name")))
    extra = tables["variant_tags"].select("pattern_id", "direction_group", "frequency")
    tagged = canonical.join_tags(core, tables["variant_tags"], token).join(extra, "pattern_id", "left")
    placed = canonical.disposition(canonical.base_references(tagged, c["base_depth"]), c["canonical_roles"], c["backbone_roles"])
    patterns = placed.select("pattern_id", "pattern_key", "route", "role", F.col("base_id").alias("base_pattern_id_raw"), "base_ref", "base_ref_resolved", "direction_group", F.coalesce("frequency", F.col("n_trips").cast("int")).alias("frequency"), "n_stops", "is_loop", "is_drt", "in_canonical", "in_backbone")
    full = placed.select("pattern_id", "pattern_key", "route_name", "route", "role", "role_scope", "lineage", "n_trips", "in_canonical", "in_backbone", "disposition", "reason", "direction_group")
    listed = tables["route_union"].select(names.base_name(F.col("route_name")).alias("route"), "stop_id").join(tables["stops"].select("stop_id", "lineage"), "stop_id", "left")
    backbone = canonical.backbone_stops(placed, pattern_stops).join(placed.select("pattern_id", "direction_group"), "pattern_id").select("route", "direction_group", "pattern_id", "seq", "stop_id")
    return {
        "patterns": patterns,
        "canonical_rows": patterns.where("in_canonical"),
        "pattern_stops": pattern_stops,
        "pattern_disposition": full.drop("pattern_key", "route_name", "direction_group"),
        "backbone_stops": backbone,
        "trip_attribution": canonical.attribute_trips(tables["trips"], placed, token),
        "support_attribution": canonical.support_runs(placed, token),
        "duplicates": canonical.duplicates(placed),
        "route_catalog": canonical.classify_routes(canonical.catalog(placed, listed), rules, check_counts=check_counts),
    }


def canonical_actual(tables: Tables, params: dict, rules: dict, check_counts: bool = True) -> Tables:
    """events, route_master -> trips, trip_events, registries, main proposal; the stop grid is passed through."""
    keys = ("service_date", "obe_id", "pattern_id")
    trips, numbered = sequences.reconstruct_trips(tables["events"], canonical.boundary_prefixes(rules), keys)
    registry = canonical.pattern_registry(tables["events"], trips, tables["route_master"], rules)
    return {
        "trips": trips,
        "trip_events": numbered,
        "pattern_registry": registry,
        "route_registry": canonical.route_registry(registry, rules, check_counts),
        "main_proposal": canonical.main_proposal(registry),
        "route_master": tables["route_master"],
    }


def merge_places(tables: Tables, params: dict, scope: str, overrides: list[dict] = (), aliases: dict[str, str] | None = None) -> Tables:
    """stops -> places, stop_place_map, override_applied, diag_under_merge, diag_alias."""
    p, prefix = params["places"], {"planned": "PB", "actual": "PA"}[scope]
    members = places.cluster(places.named(tables["stops"], aliases), p["linkage_m"], prefix)
    members, audit = places.apply_overrides(members.drop("stop_name"), list(overrides), prefix)
    table, mapped = places.geometry(members)
    by_place = members.withColumn("name_norm", F.col("place_name"))
    spark = members.sparkSession
    return {
        "places": table,
        "stop_place_map": mapped,
        "override_applied": spark.createDataFrame([tuple(a.values()) for a in audit], "row_no int, action string, place_a string, place_b string, result_place_id string, n_stops_merged int, reason string, source string"),
        "diag_under_merge": places.under_merged(by_place, p["under_merge_m"]),
        "diag_alias": places.alias_candidates(by_place, table, p["alias_m"]),
    }


def hubs(tables: Tables, params: dict, overrides: DataFrame | None = None) -> Tables:
    """backbone_stops, route_catalog, patterns, pattern_stops, places, stop_place_map -> graph, metrics, classes, reports."""
    h = params["hubs"]
    routes = network.universe_routes(tables["route_catalog"], h["universe_classes"])
    p, m = tables["places"], tables["stop_place_map"]
    scratch = Scratch(p.sparkSession, "hubs")
    edges = scratch.put(network.edges(network.place_steps(tables["backbone_stops"], m, routes), p), "edges")
    d = network.degree(edges, p)
    angles = sorted({float(a) for a in h["grid"]["arm_degrees"]} | {float(h["arm_degrees"])})
    by_angle = network.arms(network.bearings(edges, p), p, angles)
    broken = scratch.put(network.first_violations(edges, max([*h["grid"]["k_max"], h["k_max"]])), "violations")
    life = network.lifetimes(broken, d, h["mask"], h["dominance"], h["k_max"])
    arms = by_angle.select("place_id", F.col(f"A_{float(h['arm_degrees']):g}").alias("A"))
    metrics = network.metrics(d, arms, life, p, h["gate_degree"])
    q = network.qualify(metrics, h["thresholds"])
    if overrides is None:
        overrides = q.sparkSession.createDataFrame([], "row_no int, place_id string, hub_class string")
    return {
        "l_space_place_edges": edges,
        "place_metrics": metrics,
        "hub_qualification": network.apply_hub_overrides(q, overrides),
        "sensitivity": network.sensitivity(d, by_angle, broken, h, h["grid"], h["thresholds"], h["gate_degree"]),
        "diag_lspace_gap": network.explain_isolated(metrics, tables["patterns"], tables["pattern_stops"], m, routes),
    }


def precision_near(hub_places: DataFrame, official: DataFrame, n: int, radius_m: float = 150.0) -> float:
    """Share of the n best hubs (by lifetime, degree) with an official hub within the radius (a view beside the reference tables)."""
    best = hub_places.orderBy(F.desc("L"), F.desc("D"), "place_id").limit(n)
    near = official.select(F.col("lat").alias("y"), F.col("lon").alias("x")).crossJoin(F.broadcast(best))
    hit = near.where(geo.haversine(F.col("lat_centroid"), F.col("lon_centroid"), F.col("y"), F.col("x")) <= radius_m).select("place_id").distinct().count()
    total = best.count()
    if not total:
        raise ContractViolation("no hubs to compare")
    return hit / total


def defaults() -> dict:
    return config.load()
