"""Operators on small hand-made tables, and lifetimes against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wayfare.errors import ContractViolation
from wayfare.functions import geo
from wayfare.operators import canonical, joins, network, places, sequences
from wayfare.operators.components import connected_components

M = 1 / geo.DEGREE_M  # degrees of latitude in a metre


def stops(spark, rows):
    return spark.createDataFrame([(i, n, 35.0 + y * M, 129.0) for i, n, y in rows], "stop_id string, stop_name string, lat double, lon double")


def clusters(spark, rows, limit=150.0, aliases=None):
    out = places.cluster(places.named(stops(spark, rows), aliases), limit)
    return {r["stop_id"]: r["label"] for r in out.collect()}


def test_components_and_edge_cases(spark):
    e = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (9, 8), (7, 7), (None, 1)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(e).collect()}
    assert got == {2: 2, 3: 2, 4: 2, 5: 2, 8: 8, 9: 8, 7: 7}
    assert connected_components(e.limit(0)).count() == 0


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_linkage_is_inclusive_and_chains(spark):
    assert clusters(spark, [("a", "N", 0), ("b", "N", 140), ("c", "N", 280), ("d", "M", 1)]) == {"a": "a", "b": "a", "c": "a", "d": "d"}
    assert clusters(spark, [("a", "N", 0), ("b", "N", 151)]) == {"a": "a", "b": "b"}
    assert clusters(spark, [("a", "N", 0), ("b", " A ", 10)], aliases={"A": "N"}) == {"a": "a", "b": "a"}


def test_diagnostics(spark):
    m = places.cluster(places.named(stops(spark, [("a", "N", 0), ("b", "N", 200), ("c", "M", 220)])))
    u = places.under_merged(m).collect()
    assert len(u) == 1 and abs(u[0]["gap_m"] - 200) < 0.01 and u[0]["n_clusters_of_name"] == 2
    a = places.alias_candidates(m, places.geometry(m)[0], 30.0).collect()
    assert len(a) == 1 and {a[0]["name_a"], a[0]["name_b"]} == {"M", "N"}


def test_overrides_chain_and_reject(spark):
    m = places.cluster(places.named(stops(spark, [("a", "N", 0), ("b", "M", 500), ("c", "K", 900)])))
    ids = {r["stop_id"]: r["place_id"] for r in m.collect()}
    first = {"action": "merge", "place_a": ids["b"], "place_b": ids["a"]}
    _, audit = places.apply_overrides(m, [first])
    chain = [first, {"action": "merge", "place_a": audit[0]["result_place_id"], "place_b": ids["c"]}]
    out, audit = places.apply_overrides(m, chain)
    assert {r["place_name"] for r in out.collect()} == {"M"} and audit[1]["n_stops_merged"] == 3
    assert places.apply_overrides(m, [])[1] == []
    for bad in ({"action": "split", "place_a": ids["a"], "place_b": ids["b"]}, {"action": "merge", "place_a": ids["a"], "place_b": ids["a"]}, {"action": "merge", "place_a": ids["a"], "place_b": "nowhere"}):
        with pytest.raises(ContractViolation):
            places.apply_overrides(m, [bad])
    with pytest.raises(ContractViolation):
        places.apply_overrides(m, [first, first])


def test_nearest_in_block(spark):
    s = spark.createDataFrame([("a", "N", 35.0, 129.0), ("b", "N", 35.0 + 50 * M, 129.0)], "stop_id string, stop_name string, lat double, lon double")
    rows = spark.createDataFrame([(1, "N", 50.5), (2, "N ", 3.0), (3, "X", 0.0), (4, "A", 0.2)], "row_id int, name string, y double")
    rows = rows.select("row_id", "name", (F.lit(35.0) + F.col("y") * M).alias("lat"), F.lit(129.0).alias("lon"))
    good, bad = joins.nearest_in_block(rows, s, "row_id", "name", "lat", "lon", 1.0, {"A": "N"})
    assert {r["row_id"]: (r["stop_id"], r["via_alias"]) for r in good.collect()} == {1: ("b", False), 4: ("a", True)}
    assert {r["row_id"]: r["reason"] for r in bad.collect()} == {2: "too_far", 3: "no_name_match"}


def graph(spark, pairs, at=None):
    nodes = sorted({x for p in pairs for x in p} | set(at or {}))
    at = at or {n: (i, 2 * i) for i, n in enumerate(nodes)}
    p = spark.createDataFrame([(n, n, 35.0 + at[n][0] * M * 100, 129.0 + at[n][1] * M * 100) for n in nodes], "place_id string, name_norm string, lat_centroid double, lon_centroid double")
    e = spark.createDataFrame([(min(a, b), max(a, b)) for a, b in pairs], "place_a string, place_b string").distinct()
    return p, e


def arms_at(spark, degrees, theta=45.0):
    import math

    at = {"o": (0.0, 0.0)} | {f"n{i}": (math.cos(math.radians(d)), math.sin(math.radians(d)) / math.cos(math.radians(35.0))) for i, d in enumerate(degrees)}
    p, e = graph(spark, [("o", n) for n in at if n != "o"] or [("x", "y")], at if degrees else {"o": (0, 0), "x": (5, 5), "y": (9, 9)})
    return network.arms(network.bearings(e, p), p, [theta]).where("place_id = 'o'").first()[1]


@pytest.mark.parametrize(("degrees", "n"), [([0, 90, 180, 270], 4), ([0, 180], 2), ([0, 30], 1), ([77], 1), ([], 0), ([350, 10], 1), ([22.5 * i for i in range(16)], 1)])
def test_arms(spark, degrees, n):
    assert arms_at(spark, degrees) == n


def test_place_edges(spark):
    rows = [("R1", "p1", 1, "a"), ("R1", "p1", 2, "a"), ("R1", "p1", 3, "b"), ("R2", "p2", 1, "b"), ("R2", "p2", 2, "c"), ("R2", "p2", 3, "a"), ("R9", "p9", 1, "a"), ("R9", "p9", 2, "z"), ("R1", "p3", 1, "a"), ("R1", "p3", 2, "b"), ("R1", "p3", 3, "a")]
    b = spark.createDataFrame(rows, "route string, pattern_id string, seq int, stop_id string")
    m = spark.createDataFrame([(x, x.upper()) for x in "abcz"], "stop_id string, place_id string")
    p, _ = graph(spark, [("A", "B"), ("C", "Z")])
    inside = spark.createDataFrame([("R1",), ("R2",)], "route string")
    e = {(r["place_a"], r["place_b"]): (r["n_patterns"], r["routes"]) for r in network.edges(network.place_steps(b, m, inside), p).collect()}
    assert e == {("A", "B"): (2, "R1"), ("B", "C"): (1, "R2"), ("A", "C"): (1, "R2")}
    with pytest.raises(ContractViolation):
        network.place_steps(b, m.where("stop_id <> 'c'"), inside)


def brute(pairs, mask, dominance, k_max):
    adj = {}
    for a, b in pairs:
        adj.setdefault(a, set()).add(b)
        adj.setdefault(b, set()).add(a)
    out = {}
    for p in adj:
        dist, frontier, k = {p: 0}, [p], 0
        while frontier:
            k += 1
            frontier = sorted({n for v in frontier for n in adj[v]} - set(dist))
            dist |= dict.fromkeys(frontier, k)
        last = 0
        for k in range(1, k_max + 1):
            ball = {v for v, d in dist.items() if d <= k}
            deg = {v: len(adj[v]) if mask == "masked_global" else len(adj[v] & ball) for v in ball}
            if all(deg[p] >= deg[u] if dominance == "weak" else deg[p] > deg[u] for u in ball if u != p):
                last = k
        out[p] = last
    return out


def test_lifetime_against_brute_force(spark):
    rng = random.Random(11)
    pairs = set()
    for g in range(40):
        n = rng.randint(2, 9)
        for _ in range(rng.randint(1, 12)):
            a, b = rng.randrange(n), rng.randrange(n)
            if a != b:
                pairs.add((f"{g}-{min(a, b)}", f"{g}-{max(a, b)}"))
    p, e = graph(spark, sorted(pairs))
    broken, d = network.first_violations(e, 6).cache(), network.degree(e, p)
    for mask in network.MASKS:
        for dominance in network.DOMINANCE:
            got = {r["place_id"]: r["L"] for r in network.lifetimes(broken, d, mask, dominance, 5).collect()}
            assert got == brute(pairs, mask, dominance, 5), (mask, dominance)
    with pytest.raises(ValueError):
        network.lifetimes(broken, d, "other", "weak", 5)


T = {"crossing_min_degree": 3, "crossing_min_arms": 3, "terminal_min_degree": 5, "terminal_max_arms": 2, "terminal_min_lstar": 5}


def test_qualify(spark):
    m = spark.createDataFrame([("a", 3, 3, 0), ("b", 6, 2, 7), ("c", 2, 2, 0), ("d", 5, 2, 3)], "place_id string, D int, A int, L_star int")
    assert {r[0]: r[1] for r in network.qualify(m, T).collect()} == {"a": "CROSSING", "b": "TERMINAL", "c": "NONE", "d": "NONE"}
    with pytest.raises(KeyError):
        network.qualify(m, {})
    q = network.qualify(m, T)
    o = spark.createDataFrame([(1, "a", "NONE"), (2, "a", "TERMINAL")], "row_no int, place_id string, hub_class string")
    got = {r["place_id"]: (r["hub_class"], r["hub_class_rule"], r["override_row"]) for r in network.apply_hub_overrides(q, o).collect()}
    assert got["a"] == ("TERMINAL", "CROSSING", 2) and got["b"] == ("TERMINAL", "TERMINAL", None)
    for bad in ((1, "a", "HUB"), (1, "zz", "NONE")):
        with pytest.raises(ContractViolation):
            network.apply_hub_overrides(q, spark.createDataFrame([bad], "row_no int, place_id string, hub_class string"))


def test_base_references(spark):
    t = spark.createDataFrame([("m", "main", "m"), ("c", "circular", "c"), ("b", "branch", "m"), ("d", "detour", "b"), ("z", "circular", None), ("s", "short_turn", "z")], "pattern_id string, role string, base_id string")
    got = {r["pattern_id"]: (r["base_ref"], r["base_ref_resolved"]) for r in canonical.base_references(t).collect()}
    assert got == {"m": (None, None), "c": ("c", "c"), "b": ("m", "m"), "d": ("b", "m"), "z": (None, None), "s": ("z", "z")}
    for bad in ([("b", "branch", "x")], [("a", "branch", "b"), ("b", "branch", "a")], [("a", "branch", "c"), ("c", "circular", "c")]):
        with pytest.raises(ContractViolation):
            canonical.base_references(spark.createDataFrame(bad, "pattern_id string, role string, base_id string"))


def test_pattern_representatives(spark):
    s = spark.createDataFrame([(1, "A", ["x", "y"]), (2, "A", ["x", "y"]), (3, "B", ["x", "y"]), (4, "B", ["x", "z"])], "trip_id int, pattern_id string, sequence array<string>")
    e = spark.createDataFrame([("B", ["x", "y", "x", "z"])], "pattern_id string, stop_ids array<string>")
    got = sequences.collected(sequences.representative(s, e, F.lit(True)), ["pattern_id"], "seq", "stop_id").collect()
    assert {r[0]: r[1] for r in got} == {"A": ["x", "y"], "B": ["x", "y", "x", "z"]}
    with pytest.raises(ContractViolation):
        sequences.representative(s, e, F.lit(False))
    with pytest.raises(ContractViolation):
        sequences.representative(s, e.select("pattern_id", F.array(F.lit("x")).alias("stop_ids")), F.lit(True))


def test_trips(spark):
    rows = [("d", 1, "p", i, s, 100 + i, "r") for i, s in enumerate([2, 3, 3, 5, 1, 2])]
    e = spark.createDataFrame(rows, "service_date string, vehicle_id int, pattern_id string, arr_ts int, master_seq int, arr_s int, route_name string")
    trips, events = sequences.reconstruct_trips(e)
    got = [(r["trip_no"], r["n_events"], r["start_seq"], r["partial_reason"]) for r in trips.orderBy("trip_no").collect()]
    assert got == [(1, 2, 2, "first_service"), (2, 2, 3, "detect_gap"), (3, 2, 1, "none")]
    assert events.count() == 6 and sequences.reconstruct_trips(e.limit(0))[0].count() == 0


def test_classes_and_accounting(spark):
    routes = spark.createDataFrame([("5001",), ("7",), ("7지원1",)], "route string")
    rules = {"era": "planned", "rules": [{"class": "express", "rule": r"fullmatch:\d{4}", "expect": 1}, {"class": "support", "rule": "contains:지원", "expect": 1}, {"class": "general", "rule": "fallback", "expect": 1}], "accounting": {"total": 3}}
    got = {r["route"]: r["rule_id"] for r in canonical.classify_routes(routes, rules).collect()}
    assert got == {"5001": "planned:express", "7": "planned:general", "7지원1": "planned:support"}
    for change in ({"accounting": {"total": 4}}, {"rules": [{"class": "general", "rule": "fallback", "expect": 1}]}):
        with pytest.raises(ContractViolation):
            canonical.classify_routes(routes, rules | change)


def test_radius_pairs_are_exact(spark):
    rng = random.Random(5)
    pts = [(i, 35 + rng.random() * 0.01, 129 + rng.random() * 0.01) for i in range(150)]
    df = spark.createDataFrame(pts, "stop_id int, lat double, lon double")
    got = {(r["a"], r["b"]) for r in joins.radius_pairs(df, 90.0, "stop_id").collect()}
    other = df.select(F.col("stop_id").alias("j"), F.col("lat").alias("y"), F.col("lon").alias("x"))
    want = df.crossJoin(other).where("stop_id < j").where(geo.haversine(F.col("lat"), F.col("lon"), F.col("y"), F.col("x")) <= 90.0)
    assert got == {(r["stop_id"], r["j"]) for r in want.collect()} and got


def test_radius_pairs_at_poles_date_line_and_in_blocks(spark):
    rng = random.Random(8)
    pts = [(rng.choice((90.0, -90.0, 89.9999, 89.0, 60.0, 0.0)) + rng.uniform(-0.003, 0.0), rng.choice((180.0, -180.0, 179.999, -179.999, 12.0)) + rng.uniform(-0.002, 0.002)) for _ in range(220)]
    rows = [(i, max(-90.0, y), x, "ab"[i % 2]) for i, (y, x) in enumerate(pts)]
    df = spark.createDataFrame(rows, "stop_id int, lat double, lon double, name string")
    far = lambda p, q: 2 * 6371008.8 * math.asin(min(1, math.sqrt(math.sin(math.radians(q[1] - p[1]) / 2) ** 2 + math.cos(math.radians(p[1])) * math.cos(math.radians(q[1])) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2)))
    want = {(p[0], q[0]) for p in rows for q in rows if p[0] < q[0] and far(p, q) <= 150.0}
    assert {(r["a"], r["b"]) for r in joins.radius_pairs(df, 150.0, "stop_id").collect()} == want and len(want) > 300
    inside = {(a, b) for a, b in want if (a - b) % 2 == 0}
    assert {(r["a"], r["b"]) for r in joins.radius_pairs(df, 150.0, "stop_id", block="name").collect()} == inside


def test_diameters_equal_all_pairs(spark):
    rng = random.Random(9)
    rows = [(i, f"p{i % 5}", 35 + rng.gauss(0, 0.001) * (i % 5), 129 + rng.gauss(0, 0.001)) for i in range(200)] + [(900, "one", 35.0, 129.0)]
    df = spark.createDataFrame(rows, "stop_id int, place_id string, lat double, lon double")
    want = {r["place_id"]: r["m"] for r in joins.block_pairs(df, "place_id", "stop_id").groupBy("place_id").agg(F.max("dist_m").alias("m")).collect()} | {"one": 0.0}
    assert {r["place_id"]: r["span_m"] for r in places.diameters(df).collect()} == want


def test_violations_by_reach_equal_those_by_frontiers(spark):
    rng = random.Random(10)
    pairs = {tuple(sorted(rng.sample(range(60), 2))) for _ in range(75)} | {(100 + i, 101 + i) for i in range(9)}
    pairs |= {(300, 300 + i) for i in range(1, 6)} | {(305, 306), (306, 307), (307, 320)} | {(320, 320 + i) for i in range(1, 7)}
    e = spark.createDataFrame([(f"{a:03}", f"{b:03}") for a, b in pairs], "place_a string, place_b string")
    want = network.first_violations(e, 6).where("mask = 'masked_global'")
    shown = lambda df: sorted((r["place_id"], r["dominance"], r["fails_at"]) for r in df.collect())
    assert shown(network.global_violations(e, 6)) == shown(want) and want.where("fails_at > 2").count()


def test_evidence_is_one_document_per_pattern(spark):
    from wayfare.plans.queries import _evidence

    v = spark.createDataFrame([(1, 1, ["a"]), (2, 1, ["b"]), (3, 2, ["c"])], "trip_id long, pattern_id long, sequence array<string>")
    got = {r["route"]: (r["n_variants"], sorted((x["route_id"], x["stop_ids"][0]) for x in r["variants"])) for r in _evidence(v).collect()}
    assert got == {"1": (2, [("1", "a"), ("1", "b")]), "2": (1, [("2", "c")])}
