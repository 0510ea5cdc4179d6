"""Transit inputs derived from the driver tables, as DataFrames and as SQL.

Integer arithmetic with one division, so that any engine derives the same
numbers.  ``CTES`` has the SQL of every derived table by name, in an order in
which each may use those before it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.operators import canonical, network, places, sequences
from wayfare.sources.scratch import Scratch

LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of four stops of one name; some chains merge, some split, some have a close neighbour of another name."""
    return table(spark, sf_dir, "part").selectExpr("p_partkey AS stop_id", "p_partkey div 4 AS b", "p_partkey % 4 AS m").selectExpr("*", "b - CASE WHEN b % 10 = 9 THEN 1 ELSE 0 END AS g").selectExpr(
        "stop_id",
        "concat('N', b) AS stop_name",
        "CAST(3530000 + (g * 37 % 500) * 80 + m * (b % 5 + 1) * 40 + CASE WHEN b % 10 = 9 THEN 15 ELSE 0 END AS DOUBLE) / 100000D AS lat",
        "CAST(12900000 + (g * 101 % 5003) * 80 AS DOUBLE) / 100000D AS lon",
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places.cluster(places.named(stops(spark, sf_dir)))


def injured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members with faults: names whose number is a multiple of six are one place each, of the next ones odd and even stops are torn apart."""
    n = F.substring("name_norm", 2, 20).cast("long") % 6
    torn = F.concat("place_id", (F.col("stop_id") % 2).cast("string"))
    return members(spark, sf_dir).withColumn("place_id", F.when(n == 0, F.col("name_norm")).when(n == 1, torn).otherwise(F.col("place_id")))


def geometry(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return places.geometry(members(spark, sf_dir))


def route_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a pattern, its lines in a total order are its stops; 128 orders are a route and follow one path of names."""
    n_names = table(spark, sf_dir, "part").agg(F.floor(F.count(F.lit(1)) / 4).alias("n_names"))
    lines = table(spark, sf_dir, "lineitem")
    seq = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    rows = lines.select(F.expr("l_orderkey div 128").alias("r"), "l_orderkey", "l_partkey", seq.alias("seq")).crossJoin(F.broadcast(n_names))
    name = F.expr("(r * 1013 + seq * seq * (1 + r % 5) * 7) % n_names")
    return rows.select(
        F.col("r").cast("string").alias("route"),
        F.concat(F.lit("P"), "l_orderkey").alias("pattern_id"),
        "seq",
        (name * 4 + F.col("l_partkey") % 4).alias("stop_id"),
    )


def graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(places, stop map, edges)."""
    scratch = Scratch(spark, "graph")
    found = places.geometry(scratch.put(members(spark, sf_dir), "members"))
    p, m = (scratch.put(df, name) for df, name in zip(found, ("places", "map"), strict=True))
    return p, m, scratch.put(network.edges(network.place_steps(route_stops(spark, sf_dir), m, strict=False), p), "edges")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream as an arrival log: calendar date as service date, user as vehicle, ``k`` as stop number."""
    e = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        day.alias("service_date"), F.col("user_id").alias("vehicle_id"), F.pmod(F.col("user_id"), F.lit(7)).cast("string").alias("pattern_id"),
        F.col("ts").alias("arr_ts"), k.alias("master_seq"), F.timestamp_diff("SECOND", day.cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz")).cast("int").alias("arr_s"),
        F.concat(F.lit("R"), F.pmod(F.col("user_id"), F.lit(7)).cast("string")).alias("route_name"), "event_type", "value",
    )


def trips(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return sequences.reconstruct_trips(log(spark, sf_dir), ("6",))


def tagged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(patterns, tags): five patterns a route, with roles and base references."""
    o = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS pattern_id", "o_orderkey div 5 AS r", "o_orderkey % 5 AS step", "1 + o_custkey % 7 AS n_trips")
    patterns = o.selectExpr("pattern_id", "concat('', r, CASE WHEN step = 4 AND r % 11 = 0 THEN '지원1' ELSE '' END) AS route", "CASE WHEN r % 4 = 0 THEN 'ACC0' ELSE 'TAGO' END AS lineage", "n_trips")
    tags = o.where("NOT (step = 4 AND r % 11 = 0)").selectExpr(
        "pattern_id",
        "CASE step WHEN 0 THEN CASE WHEN r % 3 = 0 THEN 'circular' ELSE 'main' END WHEN 1 THEN 'short_turn' WHEN 2 THEN 'branch' WHEN 3 THEN 'detour' ELSE CASE WHEN r % 7 = 0 THEN 'circular' ELSE 'extension' END END AS role",
        "CASE WHEN step = 0 THEN CASE WHEN r % 3 <> 0 AND r % 2 = 0 THEN pattern_id END WHEN step = 4 AND r % 7 = 0 THEN pattern_id ELSE pattern_id - 1 END AS base_id",
        "step = 0 AND r % 3 = 0 AS is_loop",
    )
    return patterns, tags


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    patterns, tags = tagged(spark, sf_dir)
    return canonical.base_references(canonical.join_tags(patterns, tags, "지원"))


def talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as trips of patterns: turn as place in the sequence, role as stop."""
    return table(spark, sf_dir, "conversations").selectExpr("conv_id AS trip_id", "conv_id % 9 AS pattern_id", "turn AS seq", "role AS stop_id")


def haversine_sql(y1: str, x1: str, y2: str, x2: str) -> str:
    return f"(12742017.6::DOUBLE * asin(sqrt(pow(sin(radians({y2} - {y1}) / 2), 2) + cos(radians({y1})) * cos(radians({y2})) * pow(sin(radians({x2} - {x1}) / 2), 2))))"


def bearing_sql(y1: str, x1: str, y2: str, x2: str) -> str:
    d = f"radians({x2} - {x1})"
    return f"fmod(degrees(atan2(sin({d}) * cos(radians({y2})), cos(radians({y1})) * sin(radians({y2})) - sin(radians({y1})) * cos(radians({y2})) * cos({d}))) + 720.0, 360.0)"


_H = haversine_sql("a.lat", "a.lon", "b.lat", "b.lon")
CTES = {
    "stops": """SELECT stop_id, 'N' || b AS stop_name,
  (3530000 + (g * 37 % 500) * 80 + m * (b % 5 + 1) * 40 + CASE WHEN b % 10 = 9 THEN 15 ELSE 0 END)::DOUBLE / 100000::DOUBLE AS lat,
  (12900000 + (g * 101 % 5003) * 80)::DOUBLE / 100000::DOUBLE AS lon
  FROM (SELECT p_partkey AS stop_id, p_partkey // 4 AS b, p_partkey % 4 AS m, p_partkey // 4 - CASE WHEN (p_partkey // 4) % 10 = 9 THEN 1 ELSE 0 END AS g FROM part)""",
    "near": f"SELECT a.stop_id AS u, b.stop_id AS v FROM stops a JOIN stops b ON a.stop_name = b.stop_name AND a.stop_id <> b.stop_id AND {_H} <= 150",
    "walk": "SELECT stop_id AS u, stop_id AS v FROM stops UNION SELECT w.u, n.v FROM walk w JOIN near n ON n.u = w.v",
    "members": """SELECT s.stop_id, s.stop_name AS name_norm, l.label, 'PB_' || substr(sha1(s.stop_name || '|' || l.label), 1, 8) AS place_id, s.lat, s.lon
  FROM stops s JOIN (SELECT u, min(v) AS label FROM walk GROUP BY u) l ON l.u = s.stop_id""",
    "injured": """SELECT stop_id, name_norm, CASE CAST(substr(name_norm, 2) AS BIGINT) % 6 WHEN 0 THEN name_norm WHEN 1 THEN place_id || stop_id % 2 ELSE place_id END AS place_id, lat, lon FROM members""",
    "injured_walk": """SELECT stop_id AS u, stop_id AS v FROM injured UNION SELECT w.u, n.v FROM injured_walk w JOIN near n ON n.u = w.v
  JOIN injured a ON a.stop_id = n.u JOIN injured b ON b.stop_id = n.v WHERE a.place_id = b.place_id""",
    "places": f"""SELECT m.place_id, min(name_norm) AS name_norm, count(*) AS n_stops, round(avg(lat), 6) AS lat_centroid, round(avg(lon), 6) AS lon_centroid,
  coalesce(any_value(span), 0) AS span_m FROM members m LEFT JOIN (SELECT a.place_id, max({_H}) AS span FROM members a JOIN members b ON a.place_id = b.place_id AND a.stop_id < b.stop_id GROUP BY a.place_id) s ON s.place_id = m.place_id GROUP BY m.place_id""",
    "route_stops": """SELECT CAST(r AS VARCHAR) AS route, 'P' || l_orderkey AS pattern_id, seq,
  (r * 1013 + seq * seq * (1 + r % 5) * 7) % (SELECT count(*) // 4 FROM part) * 4 + l_partkey % 4 AS stop_id
  FROM (SELECT l_orderkey // 128 AS r, l_orderkey, l_partkey,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS seq FROM lineitem)""",
    "visits": "SELECT r.*, m.place_id, lag(m.place_id) OVER (PARTITION BY route, pattern_id ORDER BY seq) AS before FROM route_stops r JOIN members m USING (stop_id)",
    "steps": """SELECT route, pattern_id, seq, from_place, to_place FROM (SELECT route, pattern_id, seq, place_id AS from_place, lead(place_id) OVER (PARTITION BY route, pattern_id ORDER BY seq) AS to_place
  FROM visits WHERE before IS NULL OR before <> place_id) WHERE to_place IS NOT NULL""",
    "edges": f"""SELECT e.*, {haversine_sql("p.lat_centroid", "p.lon_centroid", "q.lat_centroid", "q.lon_centroid")} AS gap_m FROM (
  SELECT least(from_place, to_place) AS place_a, greatest(from_place, to_place) AS place_b, count(DISTINCT pattern_id) AS n_patterns, count(DISTINCT route) AS n_routes,
  string_agg(DISTINCT route, '|' ORDER BY route) AS routes FROM steps GROUP BY 1, 2) e JOIN places p ON p.place_id = place_a JOIN places q ON q.place_id = place_b""",
    "adj": "SELECT place_a AS p, place_b AS q FROM edges UNION ALL SELECT place_b, place_a FROM edges",
    "deg": "SELECT p.place_id, count(a.q) AS d FROM places p LEFT JOIN adj a ON a.p = p.place_id GROUP BY p.place_id",
    "turns": f"""SELECT a.p, {bearing_sql("x.lat_centroid", "x.lon_centroid", "y.lat_centroid", "y.lon_centroid")} AS bearing, a.q FROM adj a JOIN places x ON x.place_id = a.p JOIN places y ON y.place_id = a.q""",
    "gaps": "SELECT p, bearing, coalesce(lead(bearing) OVER w, first_value(bearing) OVER w + 360) - bearing AS gap FROM turns WINDOW w AS (PARTITION BY p ORDER BY bearing, q)",
    "arms": "SELECT place_id, coalesce(a30, 0) AS a30, coalesce(a45, 0) AS a45, coalesce(a60, 0) AS a60 FROM places LEFT JOIN (SELECT p, greatest(1, count(*) FILTER (gap >= 30)) AS a30, greatest(1, count(*) FILTER (gap >= 45)) AS a45, greatest(1, count(*) FILTER (gap >= 60)) AS a60 FROM gaps GROUP BY p) g ON g.p = place_id",
    "reach": """SELECT p, p AS v, 0 AS k, d AS dp, d AS dv FROM (SELECT DISTINCT p FROM adj) JOIN deg ON place_id = p
  UNION SELECT r.p, a.q, r.k + 1, r.dp, y.d FROM reach r JOIN adj a ON a.p = r.v JOIN deg y ON y.place_id = a.q
  WHERE r.k < 15 AND r.p NOT IN (SELECT x.p FROM reach x WHERE x.dv > x.dp)""",
    "dist": "SELECT p, v, min(k) AS k FROM reach GROUP BY p, v",
    "inner_deg": "SELECT d.p, d.v, count(*) AS n FROM dist d JOIN adj a ON a.p = d.v JOIN dist e ON e.p = d.p AND e.v = a.q AND e.k <= d.k GROUP BY d.p, d.v",
    "fails": """SELECT p, mask, dominance, min(f) AS fails_at FROM (
  SELECT d.p, unnest(['masked_global', 'subgraph']) AS mask, 'weak' AS dominance, unnest([d.k, CASE WHEN coalesce(i.n, 0) > x.d THEN d.k ELSE d.k + 1 END]) AS f
    FROM dist d JOIN deg x ON x.place_id = d.p JOIN deg y ON y.place_id = d.v LEFT JOIN inner_deg i ON i.p = d.p AND i.v = d.v WHERE d.k > 0 AND y.d > x.d
  UNION ALL
  SELECT d.p, unnest(['masked_global', 'subgraph']), 'strict', unnest([d.k, CASE WHEN coalesce(i.n, 0) >= x.d THEN d.k ELSE d.k + 1 END])
    FROM dist d JOIN deg x ON x.place_id = d.p JOIN deg y ON y.place_id = d.v LEFT JOIN inner_deg i ON i.p = d.p AND i.v = d.v WHERE d.k > 0 AND y.d >= x.d) GROUP BY ALL""",
    "metrics": """SELECT g.place_id, p.name_norm, g.d AS D, a.a45 AS A, CASE WHEN g.d = 0 THEN 0 ELSE least(10, coalesce(f.fails_at - 1, 10)) END AS L
  FROM deg g JOIN places p USING (place_id) JOIN arms a USING (place_id) LEFT JOIN fails f ON f.p = g.place_id AND f.mask = 'masked_global' AND f.dominance = 'weak'""",
    "log": """SELECT CAST(ts AS DATE) AS service_date, user_id AS vehicle_id, CAST(user_id % 7 AS VARCHAR) AS pattern_id, ts AS arr_ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS master_seq,
  CAST(floor(epoch(ts) - epoch(CAST(CAST(ts AS DATE) AS TIMESTAMP))) AS INTEGER) AS arr_s, 'R' || user_id % 7 AS route_name, event_type, value FROM events""",
    "numbered": """SELECT *, 1 + sum(CASE WHEN master_seq <= before THEN 1 ELSE 0 END) OVER (PARTITION BY service_date, vehicle_id, pattern_id ORDER BY arr_ts, master_seq ROWS UNBOUNDED PRECEDING) AS trip_no FROM (
  SELECT *, lag(master_seq) OVER (PARTITION BY service_date, vehicle_id, pattern_id ORDER BY arr_ts, master_seq) AS before FROM log)""",
    "log_trips": """SELECT strftime(service_date, '%Y-%m-%d') || '_' || vehicle_id || '_' || pattern_id || '_' || CASE WHEN trip_no > 999 THEN CAST(CAST(trip_no AS BIGINT) AS VARCHAR) ELSE lpad(CAST(CAST(trip_no AS BIGINT) AS VARCHAR), 3, '0') END AS trip_uid,
  service_date, vehicle_id, pattern_id, CAST(trip_no AS INTEGER) AS trip_no, arg_min(route_name, (arr_ts, master_seq)) AS route_name, count(*) AS n_events, arg_min(master_seq, (arr_ts, master_seq)) AS start_seq, arg_max(master_seq, (arr_ts, master_seq)) AS end_seq,
  arg_min(arr_s, (arr_ts, master_seq)) AS start_s, arg_max(arr_s, (arr_ts, master_seq)) AS end_s FROM numbered GROUP BY service_date, vehicle_id, pattern_id, trip_no""",
    "pat": "SELECT o_orderkey AS pattern_id, o_orderkey // 5 AS r, o_orderkey % 5 AS step, 1 + o_custkey % 7 AS n_trips FROM orders",
    "patterns": "SELECT pattern_id, r || CASE WHEN step = 4 AND r % 11 = 0 THEN '지원1' ELSE '' END AS route, CASE WHEN r % 4 = 0 THEN 'ACC0' ELSE 'TAGO' END AS lineage, n_trips FROM pat",
    "tags": """SELECT pattern_id, CASE step WHEN 0 THEN CASE WHEN r % 3 = 0 THEN 'circular' ELSE 'main' END WHEN 1 THEN 'short_turn' WHEN 2 THEN 'branch' WHEN 3 THEN 'detour' ELSE CASE WHEN r % 7 = 0 THEN 'circular' ELSE 'extension' END END AS role,
  CASE WHEN step = 0 THEN CASE WHEN r % 3 <> 0 AND r % 2 = 0 THEN pattern_id END WHEN step = 4 AND r % 7 = 0 THEN pattern_id ELSE pattern_id - 1 END AS base_id, step = 0 AND r % 3 = 0 AS is_loop FROM pat WHERE NOT (step = 4 AND r % 11 = 0)""",
    "joined": "SELECT p.*, coalesce(t.role, 'support') AS role, t.base_id, t.is_loop, t.pattern_id IS NOT NULL AS tagged FROM patterns p LEFT JOIN tags t USING (pattern_id)",
    "refs": "SELECT *, CASE WHEN role = 'main' AND base_id = pattern_id THEN NULL ELSE base_id END AS base_ref FROM joined",
    "chain": """SELECT pattern_id, base_ref AS at, 0 AS hops FROM refs WHERE base_ref IS NOT NULL AND role IN ('short_turn', 'branch', 'detour', 'extension')
  UNION SELECT c.pattern_id, r.base_ref, c.hops + 1 FROM chain c JOIN refs r ON r.pattern_id = c.at WHERE NOT (r.role = 'main' OR (r.role = 'circular' AND r.base_id IS NULL)) AND r.base_ref IS NOT NULL AND c.hops < 4""",
    "ends": "SELECT c.pattern_id, c.at AS root FROM chain c JOIN refs r ON r.pattern_id = c.at WHERE r.role = 'main' OR (r.role = 'circular' AND r.base_id IS NULL)",
    "resolved": "SELECT r.*, CASE WHEN r.role IN ('short_turn', 'branch', 'detour', 'extension') THEN e.root ELSE r.base_ref END AS base_ref_resolved FROM refs r LEFT JOIN ends e USING (pattern_id)",
    "scoped": "SELECT *, CASE WHEN role = 'circular' THEN CASE WHEN base_id IS NULL THEN 'circular_baseless' ELSE 'circular_with_base' END ELSE role END AS role_scope FROM resolved",
    "disposed": """SELECT *, role_scope IN ('main', 'circular_baseless', 'short_turn', 'branch') AS in_canonical, role_scope IN ('main', 'circular_baseless') AS in_backbone,
  CASE WHEN role = 'support' THEN 'support' WHEN role_scope IN ('main', 'circular_baseless', 'short_turn', 'branch') THEN 'canonical' ELSE 'excl_' || role_scope END AS disposition FROM scoped""",
    "talk": "SELECT conv_id AS trip_id, conv_id % 9 AS pattern_id, turn AS seq, role AS stop_id FROM conversations",
    "seqs": "SELECT trip_id, any_value(pattern_id) AS pattern_id, string_agg(stop_id, '|' ORDER BY seq) AS sequence FROM talk GROUP BY trip_id",
}


def sql(final: str, more: dict[str, str] | None = None) -> str:
    """A query over the derived tables and ``more`` of its own: those that it needs, and those that these need, come first."""
    known = CTES | (more or {})
    need: set[str] = set()
    todo = [final]
    while todo:
        text = todo.pop()
        for name in known:
            if name not in need and re.search(rf"\b{name}\b", text):
                need.add(name)
                todo.append(known[name])
    if not need:
        return final
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({known[n]})" for n in known if n in need) + "\n" + final
