"""One query per operator over the derived transit tables, each with the same question in SQL.

rounded to millimetres and thousandths of a degree.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare import config
from wayfare.checks import primitives
from wayfare.functions import geo, names, times
from wayfare.operators import canonical, joins, network, places, sequences
from wayfare.plans import fixtures as fx
from wayfare.plans.fixtures import haversine_sql, sql
from wayfare.sources import loaders, sinks
from wayfare.sources.scratch import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, more: dict[str, str] | None = None, shared: bool = True):
    """Registers a query and its SQL; ``more`` are derived tables of that SQL alone, without ``shared`` it stands as it is."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            whole = {c: F.col(c).cast("long") for c, t in df.dtypes if t in ("tinyint", "smallint", "int")}
            return df.withColumns(whole) if whole else df

        run.__name__, run.__doc__ = name, f.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = sql(oracle, more) if shared else oracle
        return f

    return register


def _mm(*columns: str):
    return {c: F.round(c, 3) for c in columns}


# ---- 2.1 scans, sources, sinks

_HMS = "CAST({h} AS STRING) || ':' || lpad(CAST({m} AS STRING), 2, '0') || ':' || lpad(CAST({s} AS STRING), 2, '0')"


@query("SC1_parquet_scan", "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation")
def _(spark, sf):
    return loaders.scan(spark, [f"{sf}/none", sf], "nation", fx.table(spark, sf, "nation").schema)


def _raw_stops(spark, sf, suffix: str) -> DataFrame:
    s = fx.stops(spark, sf)
    return s.select(F.concat(F.col("stop_id").cast("string"), F.lit(suffix)).alias("stop_id"), "stop_name", F.col("lat").cast("string").alias("stop_lat"), F.col("lon").cast("string").alias("stop_lon"))


_WIDE = {"lat_min": 35.0, "lat_max": 36.0, "lon_min": 128.0, "lon_max": 134.0}


@query("SC2_stop_loader", "SELECT CAST(stop_id AS VARCHAR) AS stop_id, stop_name, lat AS stop_lat, lon AS stop_lon FROM stops")
def _(spark, sf):
    raw = _raw_stops(spark, sf, ".0").withColumns({"zone": F.lit("z"), "admin_dong": F.lit("d")})
    out = loaders.load_stops_actual(raw, box=_WIDE)
    return out.select("stop_id", "stop_name", F.col("stop_lat").cast("double").alias("stop_lat"), F.col("stop_lon").cast("double").alias("stop_lon"))


def _raw_schedule(spark, sf) -> DataFrame:
    r = fx.route_stops(spark, sf).withColumn("t", F.lit(21600) + F.col("seq") * 130)
    order = F.substring("pattern_id", 2, 20)
    rid = F.concat(F.lit("BR_ACC0_"), F.lpad(order, 8, "0"))
    clock = lambda t: F.concat((t / 3600).cast("int").cast("string"), F.lit(":"), F.lpad(((t % 3600) / 60).cast("int").cast("string"), 2, "0"), F.lit(":"), F.lpad((t % 60).cast("string"), 2, "0"))
    rows = r.select(F.concat(F.lit("R"), order).alias("route_name"), F.concat(F.lit("S"), "stop_id").alias("stop_name"), F.col("seq").cast("string").alias("stop_sequence"), clock(F.col("t")).alias("arrival_time"), clock(F.col("t") + 20).alias("departure_time"), rid.alias("route_id"), F.concat(rid, F.lit("_Ord001")).alias("trip_id"), F.concat(F.lit("BS_ACC0_"), F.lpad(F.col("stop_id").cast("string"), 8, "0")).alias("stop_id"))
    empty = spark.range(3).select(*[F.lit(None).cast("string").alias(c) for c in rows.columns])
    return rows.unionByName(empty)


@query(
    "SC3_schedule_loader",
    """SELECT 'BR_ACC0_' || lpad(substr(pattern_id, 2), 8, '0') || '_Ord001' AS trip_id, 'BR_ACC0_' || lpad(substr(pattern_id, 2), 8, '0') AS pattern_id, 'R' || substr(pattern_id, 2) AS route_name, 'BS_ACC0_' || lpad(CAST(stop_id AS VARCHAR), 8, '0') AS stop_id,
  CAST(seq AS BIGINT) AS seq, CAST(21600 + seq * 130 AS BIGINT) AS arr_s, CAST(21620 + seq * 130 AS BIGINT) AS dep_s, 'ACC0' AS lineage FROM route_stops""",
)
def _(spark, sf):
    """Loaded timetable as stop times (PF1, PF2, PF3)."""
    return stop_times(loaders.load_schedule_planned(_raw_schedule(spark, sf)))


def stop_times(raw: DataFrame) -> DataFrame:
    return raw.select("trip_id", F.col("route_id").alias("pattern_id"), "route_name", "stop_id", F.col("stop_sequence").cast("smallint").alias("seq"), times.hms24(F.col("arrival_time"), strict=True).alias("arr_s"), times.hms24(F.col("departure_time"), strict=True).alias("dep_s"), names.lineage(F.col("route_id")).alias("lineage"))


def _raw_route_list(spark, sf) -> DataFrame:
    r = fx.route_stops(spark, sf).join(fx.stops(spark, sf), "stop_id")
    clock = lambda h: F.concat(F.lit(f"{h}시 "), F.pmod(F.col("seq"), F.lit(60)).cast("string"), F.lit("분 5초"))
    texts = [F.concat(F.lit("R"), F.substring("pattern_id", 2, 20)), F.col("seq").cast("string"), F.col("seq").cast("string"), F.col("stop_name"), F.col("lat").cast("string"), F.col("lon").cast("string"), F.lit(None).cast("string"), F.concat_ws("|", clock(6), clock(7)), F.concat_ws("|", clock(6), clock(7)), F.lit("2")]
    return r.select(*[t.alias(c) for t, c in zip(texts, loaders.COLUMNS["routes_planned"], strict=True)])


@query(
    "SC4_route_list_loader",
    "SELECT 'R' || substr(pattern_id, 2) AS route_name, CAST(seq AS BIGINT) AS seq, stop_name, (21600 + (seq % 60) * 60 + 5) || '|' || (25200 + (seq % 60) * 60 + 5) AS arrivals, CAST(2 AS BIGINT) AS n FROM route_stops JOIN stops USING (stop_id)",
)
def _(spark, sf):
    """Route list with spelled-out times (F4, F6, F20)."""
    df = loaders.load_routes_planned(_raw_route_list(spark, sf))
    seconds = times.time_list(F.col("도착시간들"), times.spelled_clock)
    return df.select(F.col("노선명").alias("route_name"), F.col("정류장순서").cast("int").alias("seq"), F.col("정류장명").alias("stop_name"), F.array_join(seconds.cast("array<string>"), "|").alias("arrivals"), times.token_count(F.col("도착시간들")).alias("n"))


def _raw_events(spark, sf) -> DataFrame:
    e = fx.log(spark, sf).where("service_date = date'2024-01-02'")
    twelve = lambda t: F.concat(F.date_format(t, "yyyy-MM-dd "), F.when(F.hour(t) < 12, "오전 ").otherwise("오후 "), F.when(F.hour(t) % 12 == 0, 12).otherwise(F.hour(t) % 12).cast("string"), F.date_format(t, ":mm:ss"))
    ts = F.col("arr_ts")
    none = F.when(F.col("master_seq") % 10 == 0, "0001-01-01").otherwise(twelve(ts))
    values = [F.date_format("service_date", "yyyyMMdd"), F.col("vehicle_id").cast("string"), F.col("pattern_id"), F.col("route_name"), F.col("master_seq").cast("string"), F.lit("9"), F.lit("s"), F.concat(F.lit("T"), "master_seq"), twelve(ts), none, F.lit("35.3"), F.lit("129.1"), F.lit("z"), F.lit("d")]
    return e.select(*[v.cast("string").alias(c) for v, c in zip(values, loaders.COLUMNS["events_actual"], strict=True)])


def events_from_log(raw: DataFrame) -> DataFrame:
    """Typed events of an arrival log."""
    day = F.to_date(F.col("운행 일자"), "yyyyMMdd")
    arr, dep = times.twelve_hour(F.col("arrival_time")), times.twelve_hour(F.col("departure_time"))
    return raw.select(
        F.col("OBE_ID").alias("obe_id"), F.col("route_id").alias("pattern_id"), "route_name", F.col("버스정류장 순번").cast("smallint").alias("master_seq"), "stop_id", arr.alias("arr_ts"),
        times.service_seconds(arr, day, 0, 48).alias("arr_s"), times.service_seconds(dep, day, 0, 48).alias("dep_s"), times.is_no_departure(F.col("departure_time")).alias("dep_is_sentinel"),
        F.round(F.col("위도").cast("double"), 6).alias("lat"), F.round(F.col("경도").cast("double"), 6).alias("lon"), F.col("권역").alias("zone"), F.col("행정동").alias("admin_dong"), "stop_id_raw", F.col("운행 일자").alias("service_date"),
    )


@query(
    "SC5_event_log_loader",
    """SELECT CAST(vehicle_id AS VARCHAR) AS obe_id, pattern_id, CAST(master_seq AS BIGINT) AS master_seq, 'T' || master_seq AS stop_id, CAST(arr_s AS BIGINT) AS arr_s,
  CASE WHEN master_seq % 10 = 0 THEN NULL ELSE CAST(arr_s AS BIGINT) END AS dep_s, master_seq % 10 = 0 AS dep_is_sentinel, '20240102' AS service_date FROM log WHERE service_date = DATE '2024-01-02'""",
)
def _(spark, sf):
    """Arrival log with 12-hour times and departure sentinels (F2, F3)."""
    return events_from_log(loaders.load_events_actual(_raw_events(spark, sf))).select("obe_id", "pattern_id", "master_seq", "stop_id", "arr_s", "dep_s", "dep_is_sentinel", "service_date")


@query(
    "SC6_route_aggregate_loader",
    """SELECT substr(pattern_id, 2) AS pattern_id, CAST(seq AS BIGINT) AS seq, CASE WHEN seq % 3 = 0 THEN CAST(18000 + seq % 60 AS VARCHAR) ELSE (86400 + 3600 + seq % 60) || '|' || (36000 + seq % 60) END AS arr_list, true AS derived_from_schedule FROM route_stops""",
)
def _(spark, sf):
    """Aggregate with two time formats; times before 4 o'clock are of the next morning (F5, F6)."""
    r = fx.route_stops(spark, sf).join(fx.stops(spark, sf), "stop_id")
    s = F.pmod(F.col("seq"), F.lit(60))
    single = F.col("seq") % 3 == 0
    listed = F.when(single, F.concat(F.lit("5시 0분 "), s.cast("string"), F.lit("초"))).otherwise(F.concat(F.lit("01:00:"), F.lpad(s.cast("string"), 2, "0"), F.lit("|10:00:"), F.lpad(s.cast("string"), 2, "0")))
    order = F.substring("pattern_id", 2, 20)
    values = [order, F.concat(F.lit("R"), order), F.col("seq").cast("string"), F.col("stop_name"), F.col("lat").cast("string"), F.col("lon").cast("string"), F.lit("z"), F.lit("d"), listed, F.col("stop_id").cast("string"), F.when(single, "1").otherwise("2")]
    raw = r.select(*[v.alias(c) for v, c in zip(values, loaders.COLUMNS["routes_actual"], strict=True)])
    df = loaders.load_routes_actual(raw, box=_WIDE)
    seconds = times.time_list(F.col("도착시간들"), times.clock_token, wrap_below=4 * 3600)
    return df.select(F.col("route_id").alias("pattern_id"), F.col("stop_sequence").cast("int").alias("seq"), F.array_join(seconds.cast("array<string>"), "|").alias("arr_list"), F.lit(True).alias("derived_from_schedule"))


def _raw_tags(spark, sf) -> DataFrame:
    t = fx.tagged(spark, sf)[1]
    rid = lambda c: F.concat(F.lit("BR_ACC0_"), F.lpad(F.col(c).cast("string"), 8, "0"))
    agent = F.col("pattern_id") % 2 == 0
    flag = lambda c: F.when(c, "True").otherwise("False")
    values = [F.lit("1"), F.lit("General"), rid("pattern_id"), F.lit("a, \"b\""), F.lit("9"), F.lit("3"), flag(F.col("is_loop")), F.lit("x"), F.lit("y"), F.col("role"), F.lit("0"), F.when(F.col("base_id").isNotNull(), rid("base_id")), F.lit("high"), F.when(agent, "agent").otherwise("auto"), flag(agent), F.lit("1"), F.lit("n"), F.lit("line\nbreak")]
    return t.select(*[v.alias(c) for v, c in zip(values, loaders.COLUMNS["tags"], strict=True)])


@query(
    "SC7_tag_csv_scan",
    "SELECT 'BR_ACC0_' || lpad(CAST(pattern_id AS VARCHAR), 8, '0') AS pattern_id, role, 'BR_ACC0_' || lpad(CAST(base_id AS VARCHAR), 8, '0') AS base_id, is_loop, pattern_id % 2 = 0 AS verified FROM tags",
)
def _(spark, sf):
    """Tags written as CSV with a byte order mark and read back (SK2, PF12)."""
    path = Scratch(spark, "csv").path("tags")
    sinks.write_csv(_raw_tags(spark, sf), path)
    return loaders.typed_tags(loaders.load_tags(loaders.read_csv(spark, path, loaders.COLUMNS["tags"]))).select("pattern_id", "role", "base_id", "is_loop", "verified")


def _evidence(v) -> DataFrame:
    """One document per pattern."""
    route = F.col("pattern_id").cast("string")
    return v.groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("n_variants"), F.collect_list(F.struct(route.alias("route_id"), F.col("sequence").alias("stop_ids"))).alias("variants"))


@query("SC8_json_documents", "SELECT CAST(trip_id AS VARCHAR) AS pattern_id, string_agg(stop_id, '|' ORDER BY seq) AS stops FROM talk GROUP BY trip_id")
def _(spark, sf):
    """Documents, one for each trip as a pattern of its own, written as JSON and read with a fixed schema."""
    path = Scratch(spark, "json").path("evidence")
    v = sequences.collected(fx.talk(spark, sf), ["trip_id"], "seq", "stop_id")
    _evidence(v.withColumnRenamed("trip_id", "pattern_id")).write.json(path)
    found = spark.read.schema(loaders.EVIDENCE).json(path)
    return loaders.evidence_sequences(found).select("pattern_id", F.array_join("stop_ids", "|").alias("stops"))


@query("SC9_rule_files", "SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'express'), (2, 'ulju'), (3, 'support'), (4, 'limousine'), (5, 'general')) t(n, route_class)")
def _(spark, sf):
    return spark.createDataFrame([(i, r["class"]) for i, r in enumerate(config.rules("planned")["rules"], 1)], "n long, route_class string")


@query("SC10_override_csv", "SELECT 'merge' AS action, 'PB_' || n_nationkey AS place_a, 'PB_' || (n_nationkey + 1) AS place_b, 'why' AS reason, 'who' AS source FROM nation")
def _(spark, sf):
    path = Scratch(spark, "csv").path("overrides")
    k = F.col("n_nationkey")
    sinks.write_csv(fx.table(spark, sf, "nation").select(F.lit("merge").alias("action"), F.concat(F.lit("PB_"), k).alias("place_a"), F.concat(F.lit("PB_"), k + 1).alias("place_b"), F.lit("why").alias("reason"), F.lit("who").alias("source")), path)
    return loaders.read_csv(spark, path, places.OVERRIDE_COLUMNS)


@query("SK1_parquet_sink", "SELECT n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey, (SELECT count(*) FROM nation) AS n_written FROM nation")
def _(spark, sf):
    """Row counts are observed while writing (SK3, SK8)."""
    path = Scratch(spark, "sink").path("nation")
    n = sinks.write_parquet(fx.table(spark, sf, "nation").select("n_name", "n_regionkey"), path)
    assert n == sinks.row_count(spark, path)
    return spark.read.parquet(path).withColumn("n_written", F.lit(n).cast("long"))


@query("SK6_map_view", "SELECT p.place_id, m.D, m.A, round(span_m, 3) AS span_m, CASE WHEN m.D = 0 THEN 'no_pattern' END AS reason, row_number() OVER (ORDER BY p.place_id) - 1 AS idx FROM places p JOIN metrics m USING (place_id)")
def _(spark, sf):
    p, m, e = fx.graph(spark, sf)
    got = _metrics(spark, p, e)
    q = network.qualify(got, config.load()["hubs"]["thresholds"])
    gap = got.where("D = 0").select("place_id", F.lit("no_pattern").alias("reason"))
    return network.map_view(p, got, q, gap).select("place_id", "D", "A", F.round("span_m", 3).alias("span_m"), "reason", "idx")


@query("SK7_bounded_sample", "SELECT CAST(least(200, count(*)) AS BIGINT) AS n FROM lineitem WHERE l_quantity > 10")
def _(spark, sf):
    path = Scratch(spark, "sample").path("bad")
    sinks.write_sample(fx.table(spark, sf, "lineitem").where("l_quantity > 10"), path)
    return spark.read.option("header", True).csv(path).agg(F.count(F.lit(1)).alias("n"))


# ---- 2.2 projections, filters, predicates


@query("PF4_membership_flag", "SELECT stop_id, stop_id IN (SELECT stop_id FROM route_stops) AS in_schedule FROM stops")
def _(spark, sf):
    return canonical.membership(fx.stops(spark, sf), fx.route_stops(spark, sf)).select("stop_id", "in_schedule")


@query("PF5_disposition", "SELECT pattern_id, role_scope, in_canonical, in_backbone, disposition FROM disposed")
def _(spark, sf):
    c = config.load()["canonical"]
    d = canonical.disposition(fx.resolved(spark, sf), c["canonical_roles"], c["backbone_roles"])
    return d.select("pattern_id", "role_scope", "in_canonical", "in_backbone", "disposition")


@query("PF6_canonical_and_backbone", "SELECT in_backbone, role, count(*) AS n FROM disposed WHERE in_canonical GROUP BY ALL")
def _(spark, sf):
    c = config.load()["canonical"]
    d = canonical.disposition(fx.resolved(spark, sf), c["canonical_roles"], c["backbone_roles"])
    return d.where("in_canonical").groupBy("in_backbone", "role").agg(F.count(F.lit(1)).alias("n"))


@query("PF7_universe_filter", "SELECT from_place, to_place, count(*) AS n FROM steps WHERE CAST(route AS BIGINT) % 5 <> 0 GROUP BY ALL")
def _(spark, sf):
    _, m = fx.geometry(spark, sf)
    r = fx.route_stops(spark, sf)
    catalog = r.select("route").distinct().withColumn("route_class", F.when(F.col("route").cast("long") % 5 != 0, "general").otherwise("support"))
    steps = network.place_steps(r, m, network.universe_routes(catalog, ["general", "ulju"]))
    return steps.groupBy("from_place", "to_place").agg(F.count(F.lit(1)).alias("n"))


@query(
    "PF8_partial_reason",
    """SELECT trip_uid, start_seq > (SELECT min(master_seq) FROM log) AS is_partial, CASE WHEN start_seq = (SELECT min(master_seq) FROM log) THEN 'none' WHEN pattern_id LIKE '6%' THEN 'boundary_clip' WHEN trip_no = 1 THEN 'first_service' ELSE 'detect_gap' END AS partial_reason FROM log_trips""",
)
def _(spark, sf):
    return fx.trips(spark, sf)[0].select("trip_uid", "is_partial", "partial_reason")


@query("PF9_trip_flags", "SELECT trip_uid, end_s >= 86400 AS crosses_midnight, pattern_id LIKE '6%' AS boundary_clipped FROM log_trips")
def _(spark, sf):
    return fx.trips(spark, sf)[0].select("trip_uid", "crosses_midnight", "boundary_clipped")


@query("PF10_coordinate_box", "SELECT stop_id, lat BETWEEN 35.31 AND 35.6 AND lon BETWEEN 129.1 AND 129.5 AS ok FROM stops")
def _(spark, sf):
    return fx.stops(spark, sf).select("stop_id", geo.in_box(F.col("lat"), F.col("lon"), {"lat_min": 35.31, "lat_max": 35.6, "lon_min": 129.1, "lon_max": 129.5}).alias("ok"))


def _metrics(spark, p: DataFrame, e: DataFrame) -> DataFrame:
    h = config.load()["hubs"]
    d = network.degree(e, p)
    a = network.arms(network.bearings(e, p), p, [h["arm_degrees"]]).withColumnRenamed(f"A_{h['arm_degrees']:g}", "A")
    broken = network.global_violations if h["mask"] == "masked_global" else network.first_violations
    life = network.lifetimes(broken(e, h["k_max"]), d, h["mask"], h["dominance"], h["k_max"])
    return network.metrics(d, a, life, p, h["gate_degree"])


_CLASS = "CASE WHEN D >= 3 AND A >= 3 THEN 'CROSSING' WHEN D >= 5 AND A <= 2 AND CASE WHEN D >= 3 THEN L ELSE 0 END >= 5 THEN 'TERMINAL' ELSE 'NONE' END"


@query("hub_qualification", f"SELECT place_id, D, A, L, CASE WHEN D >= 3 THEN L ELSE 0 END AS L_star, {_CLASS} AS hub_class FROM metrics")
def _(spark, sf):
    """The flagship query: from lines of orders to classes of hubs (PF11, G1 to G6)."""
    p, _, e = fx.graph(spark, sf)
    m = _metrics(spark, p, e)
    q = network.qualify(m, config.load()["hubs"]["thresholds"])
    return m.join(q, "place_id").select("place_id", "D", "A", "L", "L_star", "hub_class")


@query("PF11_qualify", f"SELECT {_CLASS} AS hub_class, count(*) AS n FROM metrics GROUP BY 1")
def _(spark, sf):
    return QUERIES["hub_qualification"](spark, sf).groupBy("hub_class").agg(F.count(F.lit(1)).alias("n"))


# ---- 2.3 joins


@query("J1_tag_join", "SELECT pattern_id, route, role, base_id, tagged FROM joined")
def _(spark, sf):
    return canonical.join_tags(*fx.tagged(spark, sf), "지원").select("pattern_id", "route", "role", "base_id", "tagged")


@query("J2_backbone_stops", "SELECT d.route, d.pattern_id, CAST(t.seq AS BIGINT) AS seq, t.stop_id FROM disposed d LEFT JOIN talk t ON t.trip_id = d.pattern_id WHERE d.in_backbone")
def _(spark, sf):
    c = config.load()["canonical"]
    d = canonical.disposition(fx.resolved(spark, sf), c["canonical_roles"], c["backbone_roles"])
    t = fx.talk(spark, sf).select(F.col("trip_id").alias("pattern_id"), "seq", "stop_id")
    return canonical.backbone_stops(d, t)


@query("J3_lookup", "SELECT o_orderkey, n_name FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey")
def _(spark, sf):
    o, c, n = (fx.table(spark, sf, t) for t in ("orders", "customer", "nation"))
    return o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"]).select("o_orderkey", "n_name")


@query("J4_one_to_one", "SELECT stop_id, place_id, lat FROM members")
def _(spark, sf):
    m = fx.members(spark, sf)
    return joins.one_to_one(m.select("stop_id", "place_id"), fx.stops(spark, sf).select("stop_id", "lat"), "stop_id", ["lat"])


@query("J5_semi_join", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def _(spark, sf):
    big = fx.table(spark, sf, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return fx.table(spark, sf, "customer").join(big, "c_custkey", "left_semi").select("c_custkey")


@query("J6_anti_join", "SELECT DISTINCT c_custkey AS key FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def _(spark, sf):
    """Customers without a large order."""
    return joins.dangling(fx.table(spark, sf, "customer"), "c_custkey", fx.table(spark, sf, "orders").where("o_totalprice > 300000"), "o_custkey")


@query(
    "J7_full_outer_reconcile",
    """SELECT coalesce(a.k, b.k) AS o_orderkey, a.v AS left_value, b.v AS right_value, CASE WHEN b.k IS NULL THEN 'left_only' WHEN a.k IS NULL THEN 'right_only' WHEN a.v = b.v THEN 'equal' ELSE 'differs' END AS status
  FROM (SELECT o_orderkey AS k, CAST(1 + o_orderkey % 7 AS BIGINT) AS v FROM orders WHERE o_orderkey % 3 <> 0) a FULL JOIN (SELECT l_orderkey AS k, count(*) AS v FROM lineitem GROUP BY 1) b ON a.k = b.k""",
)
def _(spark, sf):
    left = fx.table(spark, sf, "orders").where("o_orderkey % 3 <> 0")
    right = fx.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    return joins.reconcile(left, right, ["o_orderkey"], 1 + F.col("o_orderkey") % 7, F.col("n"))


_PROBE = "SELECT stop_id AS row_id, 'N' || (CASE WHEN stop_id % 11 = 0 THEN -1 ELSE stop_id // 4 END) AS name, lat + (stop_id % 3) * 0.000004::DOUBLE AS lat, lon FROM stops"
_D8 = haversine_sql("p.lat", "p.lon", "s.lat", "s.lon")


def _nearest(spark, sf) -> tuple[DataFrame, DataFrame]:
    s = fx.stops(spark, sf)
    name = F.concat(F.lit(" N"), F.when(F.col("stop_id") % 11 == 0, -1).otherwise(F.expr("stop_id div 4")).cast("string"), F.lit("\t"))
    rows = s.select(F.col("stop_id").alias("row_id"), name.alias("name"), (F.col("lat") + F.col("stop_id") % 3 * F.lit(0.000004)).alias("lat"), "lon")
    return joins.nearest_in_block(rows, s, "row_id", "name", "lat", "lon", max_dist_m=0.6)


@query("J8_nearest_in_block", f"SELECT row_id, arg_min(stop_id, (d, stop_id)) AS stop_id, round(min(d), 3) AS dist_m FROM (SELECT p.row_id, s.stop_id, {_D8} AS d FROM ({_PROBE}) p JOIN stops s ON s.stop_name = p.name) GROUP BY row_id HAVING min(d) <= 0.6")
def _(spark, sf):
    return _nearest(spark, sf)[0].select("row_id", "stop_id", F.round("dist_m", 3).alias("dist_m"))


@query("J8_nearest_failures", f"SELECT p.row_id, CASE WHEN min({_D8}) IS NULL THEN 'no_name_match' ELSE 'too_far' END AS reason, round(min({_D8}), 3) AS dist_m FROM ({_PROBE}) p LEFT JOIN stops s ON s.stop_name = p.name GROUP BY p.row_id HAVING min({_D8}) IS NULL OR min({_D8}) > 0.6")
def _(spark, sf):
    return _nearest(spark, sf)[1].withColumns(_mm("dist_m"))


@query("J9_range_join_in_block", "SELECT u AS a, v AS b FROM near WHERE u < v")
def _(spark, sf):
    return joins.block_pairs(places.named(fx.stops(spark, sf)), "name_norm", "stop_id", 150.0).select("a", "b")


@query("J10_pairs_in_block", f"SELECT a.stop_name AS name_norm, a.stop_id AS a, b.stop_id AS b, round({haversine_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')}, 3) AS dist_m FROM stops a JOIN stops b ON a.stop_name = b.stop_name AND a.stop_id < b.stop_id")
def _(spark, sf):
    return joins.block_pairs(places.named(fx.stops(spark, sf)), "name_norm", "stop_id").withColumns(_mm("dist_m"))


@query("J11_radius_join", f"SELECT a.stop_id AS a, b.stop_id AS b, round({haversine_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')}, 3) AS dist_m FROM stops a JOIN stops b ON a.stop_id < b.stop_id AND abs(a.lat - b.lat) < 0.002 AND {haversine_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= 120")
def _(spark, sf):
    return joins.radius_pairs(fx.stops(spark, sf), 120.0, "stop_id").withColumns(_mm("dist_m"))


@query("J12_base_references", "SELECT pattern_id, role, base_ref, base_ref_resolved FROM resolved")
def _(spark, sf):
    return fx.resolved(spark, sf).select("pattern_id", "role", "base_ref", "base_ref_resolved")


@query("J13_rank_aligned_join", "SELECT t.trip_id, CAST(t.seq AS BIGINT) AS seq, count(*) OVER (PARTITION BY t.trip_id) AS n FROM talk t JOIN (SELECT trip_id, row_number() OVER (PARTITION BY trip_id ORDER BY seq) - 1 AS pos FROM talk) p ON p.trip_id = t.trip_id AND p.pos = t.seq")
def _(spark, sf):
    t = fx.talk(spark, sf)
    dense = sequences.dense_position(t, ["trip_id"], ["seq"]).select("trip_id", (F.col("position") - 1).cast("long").alias("seq"))
    j = t.select("trip_id", "seq").join(dense, ["trip_id", "seq"])
    return j.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("trip_id")))


# ---- 2.4 aggregations


@query("AG1_trip_summary", "SELECT trip_id, arg_min(stop_id, seq) AS first_stop, arg_max(stop_id, seq) AS last_stop, count(*) AS n_stops FROM talk GROUP BY trip_id")
def _(spark, sf):
    return sequences.summary(fx.talk(spark, sf), ["trip_id"], ["seq"], {"first_stop": "stop_id"}, {"last_stop": "stop_id"})


@query("AG2_ordered_sequences", "SELECT trip_id, sequence FROM seqs")
def _(spark, sf):
    return sequences.collected(fx.talk(spark, sf), ["trip_id"], "seq", "stop_id").select("trip_id", F.array_join("sequence", "|").alias("sequence"))


def _distinct(spark, sf) -> DataFrame:
    s = sequences.collected(fx.talk(spark, sf), ["trip_id", "pattern_id"], "seq", "stop_id")
    return sequences.distinct_sequences(s, "pattern_id")


@query("AG3_distinct_sequences", "SELECT pattern_id, count(*) AS n_rows, count(DISTINCT sequence) AS n_sequences, string_agg(DISTINCT sequence, ';' ORDER BY sequence) AS sequences FROM seqs GROUP BY pattern_id")
def _(spark, sf):
    joined = F.array_join(F.array_sort(F.transform("sequences", lambda s: F.array_join(s, "|"))), ";")
    return _distinct(spark, sf).select("pattern_id", "n_rows", "n_sequences", joined.alias("sequences"))


@query("AG4_stop_set_equality", "SELECT pattern_id, string_agg(DISTINCT stop_id, '|' ORDER BY stop_id) = 'assistant|user' AS same FROM talk GROUP BY pattern_id")
def _(spark, sf):
    union = F.array_sort(F.array_distinct(F.flatten("sequences")))
    return _distinct(spark, sf).select("pattern_id", (union == F.array(F.lit("assistant"), F.lit("user"))).alias("same"))


@query("AG5_joined_set", "SELECT l_suppkey, string_agg(DISTINCT l_returnflag, '|' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY 1")
def _(spark, sf):
    return fx.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(sequences.joined_set(F.col("l_returnflag")).alias("flags"))


@query("AG6_count_distinct", "SELECT l_suppkey, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1")
def _(spark, sf):
    return fx.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("n"))


@query("AG7_histogram", "SELECT CASE WHEN D = 0 THEN '0' WHEN D = 1 THEN '1' WHEN D = 2 THEN '2' ELSE '3+' END AS bucket, count(*) AS n FROM metrics GROUP BY 1")
def _(spark, sf):
    p, _, e = fx.graph(spark, sf)
    d = F.col("D")
    return network.degree(e, p).groupBy(F.when(d == 0, "0").when(d == 1, "1").when(d == 2, "2").otherwise("3+").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("AG8_conditional_counts", "SELECT l_returnflag, count(*) FILTER (l_discount > 0.05) AS cheap, count(*) FILTER (l_quantity >= 40) AS large FROM lineitem GROUP BY 1")
def _(spark, sf):
    return fx.table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count_if(F.col("l_discount") > 0.05).alias("cheap"), F.count_if(F.col("l_quantity") >= 40).alias("large"))


@query(
    "AG9_gap_quantiles",
    "SELECT round(quantile_cont(g, 0.5), 6) AS median, round(quantile_cont(g, 0.05), 6) AS p5, round(quantile_cont(g, 0.95), 6) AS p95, count(g) AS n FROM (SELECT start_s - lag(end_s) OVER (PARTITION BY service_date, vehicle_id, pattern_id ORDER BY trip_no) AS g FROM log_trips)",
)
def _(spark, sf):
    t = _trip_gaps(spark, sf)
    p = F.percentile("gap_s", F.array(F.lit(0.5), F.lit(0.05), F.lit(0.95)))
    return t.agg(p.alias("p"), F.count("gap_s").alias("n")).select(F.round(F.col("p")[0], 6).alias("median"), F.round(F.col("p")[1], 6).alias("p5"), F.round(F.col("p")[2], 6).alias("p95"), "n")


def _trip_gaps(spark, sf) -> DataFrame:
    """Time between the trips of a vehicle on a pattern (W5)."""
    w = Window.partitionBy("service_date", "vehicle_id", "pattern_id").orderBy("trip_no")
    return fx.trips(spark, sf)[0].withColumn("gap_s", F.col("start_s") - F.lag("end_s").over(w))


@query("AG10_centroid", "SELECT place_id, lat_centroid, lon_centroid FROM places")
def _(spark, sf):
    return fx.geometry(spark, sf)[0].select("place_id", "lat_centroid", "lon_centroid")


@query("AG11_diameter", "SELECT place_id, round(span_m, 3) AS span_m FROM places")
def _(spark, sf):
    return fx.geometry(spark, sf)[0].select("place_id", F.round("span_m", 3).alias("span_m"))


_UNDER = f"""SELECT a.name_norm, a.place_id AS place_id_a, b.place_id AS place_id_b, round(min({haversine_sql("a.lat", "a.lon", "b.lat", "b.lon")}), 3) AS gap_m,
  any_value(n.n) AS n_clusters_of_name FROM members a JOIN members b ON a.name_norm = b.name_norm AND a.place_id < b.place_id JOIN (SELECT name_norm, count(DISTINCT place_id) AS n FROM members GROUP BY 1) n ON n.name_norm = a.name_norm GROUP BY 1, 2, 3"""


@query("AG12_group_gap", f"SELECT place_id_a, place_id_b, gap_m FROM ({_UNDER})")
def _(spark, sf):
    return places.under_merged(fx.members(spark, sf)).select("place_id_a", "place_id_b", "gap_m")


@query(
    "AG13_duplicates",
    """SELECT substr(sha1(sequence), 1, 12) AS pattern_key, string_agg(DISTINCT 'p' || trip_id, '|' ORDER BY 'p' || trip_id) AS pattern_ids, string_agg(DISTINCT CAST(pattern_id AS VARCHAR), '|' ORDER BY CAST(pattern_id AS VARCHAR)) AS routes, count(*) AS n_patterns, 'keep_flag' AS policy
  FROM seqs GROUP BY sequence HAVING count(DISTINCT pattern_id) > 1""",
)
def _(spark, sf):
    s = sequences.collected(fx.talk(spark, sf), ["trip_id", "pattern_id"], "seq", "stop_id")
    keyed = s.select(names.sequence_key(F.col("sequence")).alias("pattern_key"), F.concat(F.lit("p"), "trip_id").alias("pattern_id"), F.col("pattern_id").cast("string").alias("route"))
    return canonical.duplicates(keyed)


def _proposal(spark, sf) -> DataFrame:
    o = fx.table(spark, sf, "orders")
    p = o.selectExpr("CAST(o_orderkey AS STRING) AS pattern_id", "concat('R', o_orderkey div 7) AS route_name", "1 + o_custkey % 4 AS n_trips").withColumn("variant_code", names.variant_code(F.col("pattern_id")))
    return canonical.main_proposal(p)


@query(
    "AG14_main_proposal",
    """WITH p AS (SELECT CAST(o_orderkey AS VARCHAR) AS pid, 'R' || o_orderkey // 7 AS route_name, 1 + o_custkey % 4 AS n, o_orderkey % 10 AS vc FROM orders),
t AS (SELECT *, n = max(n) OVER (PARTITION BY route_name) AS top FROM p),
g AS (SELECT route_name, count(*) AS n_patterns, count(*) FILTER (vc = 0) AS nz, min(pid) FILTER (vc = 0) AS z, max(n) FILTER (vc = 0) AS zn, string_agg(pid, '|' ORDER BY pid) FILTER (top) AS tops, count(*) FILTER (top) AS nt, max(n) AS mx FROM t GROUP BY 1),
b AS (SELECT *, CASE WHEN nz = 0 THEN 'vc0_missing' WHEN nz > 1 THEN 'vc0_multiple' WHEN nt > 1 THEN 'tie' WHEN tops = z THEN 'both' ELSE 'disagree' END AS basis FROM g)
SELECT route_name, n_patterns, CASE WHEN nz = 1 THEN z ELSE '' END AS pattern_id_vc0, CASE WHEN nz = 1 THEN CAST(zn AS BIGINT) END AS n_trips_vc0, tops AS pattern_id_top, CAST(mx AS BIGINT) AS n_trips_top, nt > 1 AS top_tie, basis, CASE WHEN basis = 'both' THEN z ELSE '' END AS main_candidate, basis <> 'both' AS needs_review FROM b""",
)
def _(spark, sf):
    return _proposal(spark, sf)


@query(
    "AG15_route_catalog",
    """SELECT coalesce(s.route, l.route) AS route, s.route IS NOT NULL AS has_schedule, coalesce(s.lin, l.lin) AS lineage, coalesce(n_patterns, 0) AS n_patterns, CAST(coalesce(n_trips, 0) AS BIGINT) AS n_trips
  FROM (SELECT route, string_agg(DISTINCT lineage, '|' ORDER BY lineage) AS lin, count(*) AS n_patterns, sum(n_trips) AS n_trips FROM patterns GROUP BY 1) s
  FULL JOIN (SELECT CAST(s_suppkey * 17 AS VARCHAR) AS route, 'LIST' AS lin FROM supplier) l ON l.route = s.route""",
)
def _(spark, sf):
    listed = fx.table(spark, sf, "supplier").select((F.col("s_suppkey") * 17).cast("string").alias("route"), F.lit("LIST").alias("lineage"))
    return canonical.catalog(fx.tagged(spark, sf)[0], listed)


@query(
    "AG16_registries",
    """SELECT pattern_id, arg_min(route_name, (arr_ts, master_seq)) AS route_name, false AS name_unknown, CAST(right(pattern_id, 1) AS BIGINT) AS variant_code, 'general' AS route_class, pattern_id LIKE '388%' AS boundary_clipped,
  (SELECT count(*) FROM log_trips t WHERE t.pattern_id = l.pattern_id) AS n_trips, count(DISTINCT master_seq) AS n_master_stops FROM log l GROUP BY pattern_id""",
)
def _(spark, sf):
    events, (trips, _) = fx.log(spark, sf), fx.trips(spark, sf)
    master = events.select("pattern_id", "master_seq").distinct()
    return canonical.pattern_registry(events, trips, master, config.rules("actual"))


@query("AG17_grid", "SELECT DISTINCT pattern_id, CAST(master_seq AS BIGINT) AS master_seq FROM log")
def _(spark, sf):
    return fx.log(spark, sf).select("pattern_id", "master_seq").distinct()


@query("AG18_distribution_text", "SELECT route, string_agg(k || ':' || n, '|' ORDER BY k) AS dist FROM (SELECT l_suppkey AS route, l_returnflag AS k, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def _(spark, sf):
    g = fx.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("route"), F.col("l_returnflag").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "n"))), lambda s: F.concat_ws(":", s["k"], s["n"].cast("string"))), "|")
    return g.groupBy("route").agg(text.alias("dist"))


@query("AG19_continuity", "SELECT c, count(*) AS n FROM (SELECT l_orderkey, CASE WHEN max(l_linenumber) - min(l_linenumber) + 1 <> count(DISTINCT l_linenumber) THEN 'gap' WHEN min(l_linenumber) <> 1 THEN 'offset' ELSE 'ok' END AS c FROM lineitem GROUP BY 1) GROUP BY 1")
def _(spark, sf):
    g = fx.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min("l_linenumber").alias("a"), F.max("l_linenumber").alias("b"), F.countDistinct("l_linenumber").alias("k"))
    c = F.when(F.col("b") - F.col("a") + 1 != F.col("k"), "gap").when(F.col("a") != 1, "offset").otherwise("ok")
    return g.groupBy(c.alias("c")).agg(F.count(F.lit(1)).alias("n"))


@query("AG20_name_counts", "SELECT CASE WHEN n >= 3 THEN '3+' ELSE CAST(n AS VARCHAR) END AS stops, count(*) AS n_names FROM (SELECT stop_name, count(DISTINCT stop_id) AS n FROM route_stops JOIN stops USING (stop_id) GROUP BY 1) GROUP BY 1")
def _(spark, sf):
    """Names by the number of their stops that a pattern serves."""
    served = fx.route_stops(spark, sf).select("stop_id").distinct()
    g = fx.stops(spark, sf).join(served, "stop_id", "left_semi").groupBy("stop_name").agg(F.count(F.lit(1)).alias("n"))
    return g.groupBy(F.when(F.col("n") >= 3, "3+").otherwise(F.col("n").cast("string")).alias("stops")).agg(F.count(F.lit(1)).alias("n_names"))


@query("AG21_rate", "SELECT round(avg(CASE WHEN start_seq > (SELECT min(master_seq) FROM log) THEN 1 ELSE 0 END), 9) AS rate, count(*) AS n FROM log_trips")
def _(spark, sf):
    return fx.trips(spark, sf)[0].agg(F.round(F.avg(F.col("is_partial").cast("int")), 9).alias("rate"), F.count(F.lit(1)).alias("n"))


# ---- 2.5 windows


_W = "OVER (PARTITION BY vehicle_id ORDER BY arr_ts, master_seq)"


def _user():
    return Window.partitionBy("vehicle_id").orderBy("arr_ts", "master_seq")


@query("W1_W2_lag_lead", f"SELECT vehicle_id, arr_ts, CAST(lag(master_seq) {_W} AS BIGINT) AS before, CAST(lead(master_seq) {_W} AS BIGINT) AS after FROM log")
def _(spark, sf):
    return fx.log(spark, sf).select("vehicle_id", "arr_ts", F.lag("master_seq").over(_user()).alias("before"), F.lead("master_seq").over(_user()).alias("after"))


@query("W3_order_violations", f"SELECT count(*) FILTER (d <= 0) AS strict, count(*) FILTER (d < 0) AS loose FROM (SELECT master_seq - lag(master_seq) {_W} AS d FROM log)")
def _(spark, sf):
    e = fx.log(spark, sf)
    a = primitives.order_violations(e, ["vehicle_id"], ["arr_ts", "master_seq"], "master_seq").withColumnRenamed("n", "strict")
    b = primitives.order_violations(e, ["vehicle_id"], ["arr_ts", "master_seq"], "master_seq", strict=False).withColumnRenamed("n", "loose")
    return a.crossJoin(b)


@query("W4_reset_sessions", "SELECT CAST(service_date AS VARCHAR) AS service_date, vehicle_id, arr_ts, CAST(trip_no AS BIGINT) AS trip_no FROM numbered")
def _(spark, sf):
    return sequences.sessions(fx.log(spark, sf), ["service_date", "vehicle_id", "pattern_id"], ["arr_ts", "master_seq"], "master_seq").select(F.col("service_date").cast("string").alias("service_date"), "vehicle_id", "arr_ts", "trip_no")


@query("W5_session_gaps", "SELECT trip_uid, CAST(start_s - lag(end_s) OVER (PARTITION BY service_date, vehicle_id, pattern_id ORDER BY trip_no) AS BIGINT) AS gap_s FROM log_trips")
def _(spark, sf):
    return _trip_gaps(spark, sf).select("trip_uid", "gap_s")


@query("W6_dense_position", f"SELECT vehicle_id, arr_ts, row_number() {_W} AS position FROM log")
def _(spark, sf):
    return sequences.dense_position(fx.log(spark, sf), ["vehicle_id"], ["arr_ts", "master_seq"]).select("vehicle_id", "arr_ts", "position")


@query("W7_collapse_repeats", "SELECT pattern_id, CAST(seq AS BIGINT) AS seq, place_id FROM visits WHERE before IS NULL OR before <> place_id")
def _(spark, sf):
    _, m = fx.geometry(spark, sf)
    rows = fx.route_stops(spark, sf).join(m, "stop_id")
    return sequences.collapsed(rows, ["route", "pattern_id"], ["seq"], "place_id").select("pattern_id", "seq", "place_id")


@query("W8_circular_gaps", "SELECT p, round(bearing, 3) AS bearing, round(gap, 3) AS gap FROM gaps")
def _(spark, sf):
    p, _, e = fx.graph(spark, sf)
    return network.bearings(e, p).withColumns(_mm("bearing", "gap"))


@query(
    "W9_block_contiguity",
    """SELECT count(*) FILTER (x IS NULL AND y IS NULL) AS all_null, count(*) FILTER ((x IS NULL) <> (y IS NULL)) AS partial_null,
  max(r) FILTER (x IS NULL AND y IS NULL) - min(r) FILTER (x IS NULL AND y IS NULL) + 1 = count(*) FILTER (x IS NULL AND y IS NULL) AS contiguous
  FROM (SELECT row_number() OVER (ORDER BY o_orderkey) AS r, CASE WHEN o_orderkey NOT BETWEEN 10 AND 19 THEN o_custkey END AS x,
    CASE WHEN o_orderkey NOT BETWEEN 10 AND 19 THEN o_orderstatus END AS y FROM orders)""",
)
def _(spark, sf):
    """Null rows of a file: how many, and whether they are one block in file order."""
    inside = F.col("o_orderkey").between(10, 19)
    o = fx.table(spark, sf, "orders").select("o_orderkey", F.when(~inside, F.col("o_custkey")).alias("x"), F.when(~inside, F.col("o_orderstatus")).alias("y"))
    path = Scratch(spark, "block").path("t")
    o.coalesce(1).sortWithinPartitions("o_orderkey").select("x", "y").write.parquet(path)
    df = spark.read.parquet(path).select("x", "y", F.col("_metadata.row_index").alias("r"))
    found = loaders.null_block(df, F.col("r"), ["x", "y"])
    return spark.createDataFrame([(found["all_null"], found["partial_null"], found["contiguous"])], "all_null long, partial_null long, contiguous boolean")


@query("W10_first_per_key", "SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1")
def _(spark, sf):
    return joins.latest(fx.table(spark, sf, "orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("W11_later_references", "SELECT a.n_nationkey::BIGINT AS row_no FROM nation a WHERE EXISTS (SELECT 1 FROM nation b WHERE b.n_nationkey > a.n_nationkey AND b.n_regionkey = a.n_regionkey)")
def _(spark, sf):
    n = fx.table(spark, sf, "nation")
    last = n.groupBy(F.col("n_regionkey").alias("r")).agg(F.max("n_nationkey").alias("last"))
    return n.join(last, n["n_regionkey"] == last["r"]).where("n_nationkey < last").select(F.col("n_nationkey").alias("row_no"))


@query("W12_adjacent_distance", f"SELECT r.pattern_id, CAST(r.seq AS BIGINT) AS seq, round({haversine_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')}, 3) AS dist_m FROM (SELECT *, lead(stop_id) OVER (PARTITION BY pattern_id ORDER BY seq) AS nxt FROM route_stops) r JOIN stops a ON a.stop_id = r.stop_id JOIN stops b ON b.stop_id = r.nxt")
def _(spark, sf):
    return adjacent_distances(fx.route_stops(spark, sf), fx.stops(spark, sf)).select("pattern_id", "seq", F.round("dist_m", 3).alias("dist_m"))


def adjacent_distances(pattern_stops: DataFrame, stops: DataFrame) -> DataFrame:
    rows = pattern_stops.join(stops.select("stop_id", "lat", "lon"), "stop_id")
    w = Window.partitionBy("pattern_id").orderBy("seq")
    rows = rows.withColumn("y", F.lead("lat").over(w)).withColumn("x", F.lead("lon").over(w)).where("y is not null")
    return rows.withColumn("dist_m", geo.haversine(F.col("lat"), F.col("lon"), F.col("y"), F.col("x")))


# ---- 2.6 and 2.7 sorts, sets


@query("S1_S2_ordered_limit", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 25")
def _(spark, sf):
    return fx.table(spark, sf, "lineitem").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey").limit(25).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("S3_rounded_gap_order", f"SELECT row_number() OVER (ORDER BY gap_m, place_id_a, place_id_b) AS n, gap_m, place_id_a, place_id_b FROM ({_UNDER}) ORDER BY 1 LIMIT 50")
def _(spark, sf):
    u = places.under_merged(fx.members(spark, sf))
    top = u.orderBy("gap_m", "place_id_a", "place_id_b").limit(50)
    return top.withColumn("n", F.row_number().over(Window.orderBy("gap_m", "place_id_a", "place_id_b"))).select("n", "gap_m", "place_id_a", "place_id_b")


@query("S4_nearest_tuple", "SELECT name_norm, arg_min(place_id, (abs(D - 9) + abs(A - 2) + abs(L - 10), D, A, L, place_id)) AS place_id FROM metrics GROUP BY name_norm")
def _(spark, sf):
    p, _, e = fx.graph(spark, sf)
    far = F.abs(F.col("D") - 9) + F.abs(F.col("A") - 2) + F.abs(F.col("L") - 10)
    return _metrics(spark, p, e).groupBy("name_norm").agg(F.min_by("place_id", F.struct(far, "D", "A", "L", "place_id")).alias("place_id"))


@query("SE1_union_all", "SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region")
def _(spark, sf):
    return fx.table(spark, sf, "nation").select(F.col("n_name").alias("name")).unionByName(fx.table(spark, sf, "region").select(F.col("r_name").alias("name")))


@query("SE2_distinct", "SELECT DISTINCT event_type FROM events")
def _(spark, sf):
    return fx.table(spark, sf, "events").select("event_type").distinct()


@query("SE3_difference", "SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 49")
def _(spark, sf):
    return fx.table(spark, sf, "part").select(F.col("p_partkey").alias("k")).subtract(fx.table(spark, sf, "lineitem").where("l_quantity > 49").select("l_partkey"))


@query("SE4_symmetric_difference", "SELECT coalesce(a.k, b.k) AS k, a.k IS NULL AS only_b FROM (SELECT DISTINCT o_custkey AS k FROM orders) a FULL JOIN (SELECT c_custkey AS k FROM customer WHERE c_custkey % 2 = 0) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL")
def _(spark, sf):
    a = fx.table(spark, sf, "orders").select(F.col("o_custkey").alias("k")).distinct()
    b = fx.table(spark, sf, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"))
    r = joins.reconcile(a, b, ["k"], F.lit(1), F.lit(1))
    return r.where("status in ('left_only', 'right_only')").select("k", (F.col("status") == "right_only").alias("only_b"))


@query("SE5_intersection", "SELECT l_partkey AS k FROM lineitem WHERE l_discount = 0.1 INTERSECT SELECT l_partkey FROM lineitem WHERE l_tax = 0.08")
def _(spark, sf):
    x = fx.table(spark, sf, "lineitem")
    return x.where("l_discount = 0.1").select(F.col("l_partkey").alias("k")).intersect(x.where("l_tax = 0.08").select("l_partkey"))


# ---- 2.8 scalar functions

_CLOCK = "(o_orderkey % 30) || ':' || lpad(CAST(o_orderkey % 66 AS VARCHAR), 2, '0') || ':' || lpad(CAST(o_custkey % 60 AS VARCHAR), 2, '0')"
_SECONDS = "(o_orderkey % 30) * 3600 + (o_orderkey % 66) * 60 + o_custkey % 60"


def _pad(c):
    return F.lpad(c.cast("string"), 2, "0")


@query("F1_service_clock", f"SELECT o_orderkey, {_CLOCK} AS t, CASE WHEN o_orderkey % 66 < 60 AND {_SECONDS} >= 14400 AND {_SECONDS} < 93600 THEN {_SECONDS} END AS s FROM orders")
def _(spark, sf):
    k = F.col("o_orderkey")
    t = F.concat((k % 30).cast("string"), F.lit(":"), _pad(k % 66), F.lit(":"), _pad(F.col("o_custkey") % 60))
    return fx.table(spark, sf, "orders").select("o_orderkey", t.alias("t")).withColumn("s", times.hms24(F.col("t")))


@query(
    "F2_F3_twelve_hour",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 14 BETWEEN 1 AND 12 THEN make_timestamp(2025, 5, 6, CAST((o_orderkey % 14) % 12 + CASE WHEN o_orderkey % 2 = 0 THEN 12 ELSE 0 END AS BIGINT), CAST(o_custkey % 60 AS BIGINT), 7.0) END AS ts,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 14 BETWEEN 1 AND 12 AND (o_orderkey % 14) % 12 + CASE WHEN o_orderkey % 2 = 0 THEN 12 ELSE 0 END >= 4 THEN CAST(((o_orderkey % 14) % 12 + CASE WHEN o_orderkey % 2 = 0 THEN 12 ELSE 0 END) * 3600 + (o_custkey % 60) * 60 + 7 AS BIGINT) END AS s, o_orderkey % 9 = 0 AS none FROM orders""",
)
def _(spark, sf):
    k = F.col("o_orderkey")
    t = F.when(k % 9 == 0, "0001-01-01").otherwise(F.concat(F.lit("2025-05-06 "), F.when(k % 2 == 0, "오후").otherwise("오전"), F.lit(" "), (k % 14).cast("string"), F.lit(":"), _pad(F.col("o_custkey") % 60), F.lit(":07")))
    df = fx.table(spark, sf, "orders").select("o_orderkey", t.alias("t")).withColumn("ts", times.twelve_hour(F.col("t")))
    return df.select("o_orderkey", "ts", times.service_seconds(F.col("ts"), F.lit("2025-05-06").cast("date")).alias("s"), times.is_no_departure(F.col("t")).alias("none"))


@query(
    "F4_F5_clock_tokens",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CASE WHEN o_orderkey % 30 < 24 THEN (o_orderkey % 30) * 3600 + (o_custkey % 60) * 60 + 5 END
  ELSE CASE WHEN o_orderkey % 30 < 24 AND o_custkey % 70 < 60 THEN (o_orderkey % 30) * 3600 + (o_custkey % 70) * 60 + 5 END END AS s FROM orders""",
)
def _(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    plain = F.concat(_pad(k % 30), F.lit(":"), _pad(c % 60), F.lit(":05"))
    spelled = F.concat((k % 30).cast("string"), F.lit("시 "), (c % 70).cast("string"), F.lit("분 5초"))
    return fx.table(spark, sf, "orders").select("o_orderkey", times.clock_token(F.when(k % 2 == 0, plain).otherwise(spelled)).alias("s"))


@query("F7_base_name", "SELECT o_orderkey, (o_orderkey // 5) || CASE WHEN o_orderkey % 3 = 2 THEN ' (a) b' ELSE '' END AS base FROM orders")
def _(spark, sf):
    k = F.col("o_orderkey")
    name = F.concat(F.lit(" "), F.expr("o_orderkey div 5").cast("string"), F.when(k % 3 == 0, "(via (x) y) ").when(k % 3 == 1, "").otherwise(" (a) b"))
    return fx.table(spark, sf, "orders").select("o_orderkey", names.base_name(name).alias("base"))


@query("F8_F9_stop_names", "SELECT stop_id, CASE WHEN stop_name = 'N3' THEN 'N7' ELSE stop_name END AS name FROM stops")
def _(spark, sf):
    padded = F.concat(F.lit("　\t"), "stop_name", F.lit(" \n"))
    return fx.stops(spark, sf).select("stop_id", names.stop_name(padded, {"N3": "N7"}).alias("name"))


@query("F10_F11_haversine_bearing", f"SELECT a.stop_id, round({haversine_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')}, 3) AS d, round({fx.bearing_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')}, 3) AS w FROM stops a JOIN stops b ON b.stop_id = a.stop_id + 17")
def _(spark, sf):
    s = fx.stops(spark, sf)
    t = s.select((F.col("stop_id") - 17).alias("stop_id"), F.col("lat").alias("y"), F.col("lon").alias("x"))
    args = (F.col("lat"), F.col("lon"), F.col("y"), F.col("x"))
    return s.join(t, "stop_id").select("stop_id", F.round(geo.haversine(*args), 3).alias("d"), F.round(geo.bearing(*args), 3).alias("w"))


@query("F12_sequence_key", "SELECT trip_id, substr(sha1(sequence), 1, 12) AS pattern_key FROM seqs")
def _(spark, sf):
    return sequences.collected(fx.talk(spark, sf), ["trip_id"], "seq", "stop_id").select("trip_id", names.sequence_key(F.col("sequence")).alias("pattern_key"))


@query("F13_place_id", "SELECT DISTINCT place_id, name_norm FROM members")
def _(spark, sf):
    return fx.members(spark, sf).select("place_id", "name_norm").distinct()


@query("F14_trip_uid", "SELECT o_orderkey, '2024-01-05_' || o_custkey || '_x_' || CASE WHEN o_orderkey > 999 THEN CAST(o_orderkey AS VARCHAR) ELSE lpad(CAST(o_orderkey AS VARCHAR), 3, '0') END AS uid FROM orders")
def _(spark, sf):
    return fx.table(spark, sf, "orders").select("o_orderkey", names.trip_uid(F.lit("2024-01-05"), F.col("o_custkey"), F.lit("x"), F.col("o_orderkey")).alias("uid"))


@query("F15_F16_F17_name_parts", "SELECT pattern_id, split_part(route, '지원', 1) AS parent, pattern_id % 10 AS vc, CAST(pattern_id AS VARCHAR) AS plain FROM patterns")
def _(spark, sf):
    p = fx.tagged(spark, sf)[0]
    s = F.col("pattern_id").cast("string")
    return p.select("pattern_id", names.parent_name(F.col("route"), "지원").alias("parent"), names.variant_code(s).alias("vc"), names.plain_id(F.concat(s, F.lit(".0"))).alias("plain"))


@query("F19_rule_predicates", "SELECT p_partkey, CASE WHEN p_partkey BETWEEN 1000 AND 9999 THEN 'express' WHEN CAST(p_partkey AS VARCHAR) LIKE '%77%' THEN 'contains' WHEN p_partkey = 5 THEN 'equal' WHEN p_partkey IN (6, 8) THEN 'listed' ELSE 'general' END AS c FROM part")
def _(spark, sf):
    rules = [("express", r"fullmatch:\d{4}"), ("contains", "contains:77"), ("equal", "equals:5"), ("listed", "in:[6, 8]"), ("general", "fallback")]
    return fx.table(spark, sf, "part").select("p_partkey", names.classify([{"class": c, "rule": r} for c, r in rules], F.col("p_partkey").cast("string")).alias("c"))


@query("F23_forbidden_names", "SELECT 'excessive_wait' AS name, 'excessive' AS term UNION ALL SELECT 'SHOULD_stop', 'should'")
def _(spark, sf):
    found = names.has_forbidden(["excessive_wait", "SHOULD_stop", "degree"], config.load()["vocabulary"]["forbidden"])
    return spark.createDataFrame(found, "name string, term string")


# ---- 2.9 graph


@query("G1_place_edges", "SELECT place_a, place_b, n_patterns, n_routes, routes, round(gap_m, 3) AS gap_m FROM edges")
def _(spark, sf):
    return fx.graph(spark, sf)[2].withColumns(_mm("gap_m"))


@query("G2_degree", "SELECT place_id, d AS D FROM deg")
def _(spark, sf):
    p, _, e = fx.graph(spark, sf)
    return network.degree(e, p)


@query("G3_arms", "SELECT place_id, a30 AS A_30, a45 AS A_45, a60 AS A_60 FROM arms")
def _(spark, sf):
    p, _, e = fx.graph(spark, sf)
    return network.arms(network.bearings(e, p), p, [30.0, 45.0, 60.0])


@query("G4_first_violations", "SELECT p AS place_id, mask, dominance, CAST(fails_at AS BIGINT) AS fails_at FROM fails")
def _(spark, sf):
    return network.first_violations(fx.graph(spark, sf)[2], 15)


@query("G5_lifetime", "SELECT place_id, CAST(L AS BIGINT) AS L FROM metrics")
def _(spark, sf):
    p, _, e = fx.graph(spark, sf)
    return network.lifetimes(network.first_violations(e, 10), network.degree(e, p), "masked_global", "weak", 10)


@query("G6_metrics", "SELECT place_id, name_norm, D, A, L, CASE WHEN D >= 3 THEN L ELSE 0 END AS L_star, D >= 1 AS in_lspace FROM metrics")
def _(spark, sf):
    p, _, e = fx.graph(spark, sf)
    return _metrics(spark, p, e)


@query(
    "G7_sensitivity",
    """WITH v AS (SELECT m.mask, d.dominance, k.k_max, 45.0::DOUBLE AS theta FROM (VALUES ('masked_global'), ('subgraph')) m(mask), (VALUES ('weak'), ('strict')) d(dominance), (VALUES (5), (10), (15)) k(k_max)
  UNION ALL SELECT 'masked_global', 'weak', 10, t FROM (VALUES (30.0::DOUBLE), (60.0)) x(t)),
r AS (SELECT v.*, g.d AS D, CASE v.theta WHEN 30 THEN a.a30 WHEN 45 THEN a.a45 ELSE a.a60 END AS A, CASE WHEN g.d < 3 THEN 0 ELSE least(v.k_max, coalesce(f.fails_at - 1, v.k_max)) END AS L
  FROM v CROSS JOIN deg g JOIN arms a USING (place_id) LEFT JOIN fails f ON f.p = g.place_id AND f.mask = v.mask AND f.dominance = v.dominance)
SELECT mask || '|' || dominance || '|k' || k_max || '|theta' || CAST(CAST(theta AS INTEGER) AS VARCHAR) AS variant_id, mask, dominance, CAST(k_max AS BIGINT) AS k_max, theta AS arm_degrees, mask = 'masked_global' AND dominance = 'weak' AND k_max = 10 AND theta = 45 AS is_adopted,
  count(*) FILTER (D >= 3 AND A >= 3) AS n_crossing, count(*) FILTER (NOT (D >= 3 AND A >= 3) AND D >= 5 AND A <= 2 AND L >= 5) AS n_terminal, count(*) FILTER ((D >= 3 AND A >= 3) OR (D >= 5 AND A <= 2 AND L >= 5)) AS n_hub_qualified FROM r GROUP BY ALL""".replace("WITH v AS", "SELECT * FROM (WITH v AS", 1)
    + ")",
)
def _(spark, sf):
    p, _, e = fx.graph(spark, sf)
    h = config.load()["hubs"]
    g = h["grid"]
    return network.sensitivity(network.degree(e, p), network.arms(network.bearings(e, p), p, g["arm_degrees"]), network.first_violations(e, max(g["k_max"])), h, g, h["thresholds"], h["gate_degree"])


@query(
    "G8_isolated_reasons",
    """SELECT m.place_id, m.name_norm, CASE WHEN count(DISTINCT c) = 0 THEN 'no_pattern' WHEN count(DISTINCT c) = 1 THEN min(c) || '_only' ELSE 'mixed_nonbackbone' END AS reason, coalesce(string_agg(DISTINCT x.route, '|' ORDER BY x.route), '') AS routes_serving
  FROM (SELECT place_id, name_norm FROM metrics WHERE D = 0) m LEFT JOIN (SELECT b.place_id, 'X' || l_orderkey % 50 AS route,
    CASE WHEN l_orderkey % 50 >= 40 THEN 'out_of_universe' WHEN l_orderkey % 3 = 0 THEN 'uncovered_circular' ELSE 'non_backbone_variant' END AS c
  FROM lineitem JOIN members b ON b.stop_id = l_partkey WHERE l_quantity >= 49) x ON x.place_id = m.place_id GROUP BY m.place_id, m.name_norm""",
)
def _(spark, sf):
    """Places without an edge; the lines of the largest quantities are the patterns beside the backbone."""
    p, m, e = fx.graph(spark, sf)
    lines = fx.table(spark, sf, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("pattern_id"), F.col("l_partkey").alias("stop_id"))
    k = F.col("pattern_id")
    route = F.concat(F.lit("X"), (k % 50).cast("string"))
    patterns = lines.select("pattern_id").distinct().select("pattern_id", route.alias("route"), F.when(k % 3 == 0, "circular").otherwise("branch").alias("role"), F.lit(False).alias("in_backbone"))
    inside = patterns.where(F.col("pattern_id") % 50 < 40).select("route").distinct()
    alone = network.degree(e, p).join(p.select("place_id", "name_norm"), "place_id")
    return network.explain_isolated(alone, patterns, lines, m, inside)


@query("G9_name_components", "SELECT stop_id, label, place_id FROM members")
def _(spark, sf):
    return fx.members(spark, sf).select("stop_id", "label", "place_id")


_HERE = haversine_sql("a.lat", "a.lon", "b.lat", "b.lon")


@query(
    "G10_cluster_validity",
    f"""SELECT count(DISTINCT place_id) AS n_places, count(DISTINCT place_id) FILTER (label <> least_label) AS n_split, any_value(n_close) AS n_too_close
  FROM (SELECT i.place_id, l.label, min(l.label) OVER (PARTITION BY i.place_id) AS least_label FROM injured i
    JOIN (SELECT u, min(v) AS label FROM injured_walk GROUP BY u) l ON l.u = i.stop_id)
  CROSS JOIN (SELECT count(*) AS n_close FROM (SELECT a.place_id, b.place_id FROM injured a JOIN injured b ON a.name_norm = b.name_norm AND a.place_id < b.place_id
    GROUP BY 1, 2 HAVING min({_HERE}) <= 150))""",
)
def _(spark, sf):
    """Places that fall apart and places of one name that are too close, in a clustering with injected faults (:func:`fixtures.injured`)."""
    return places.validity(fx.injured(spark, sf), 150.0)


@query("G11_place_geometry", f"SELECT m.stop_id, m.place_id, p.n_stops, round({haversine_sql('m.lat', 'm.lon', 'p.lat_centroid', 'p.lon_centroid')}, 3) AS dist_m FROM members m JOIN places p USING (place_id)")
def _(spark, sf):
    p, m = fx.geometry(spark, sf)
    return m.join(p, "place_id").select("stop_id", "place_id", "n_stops", F.round("dist_to_centroid_m", 3).alias("dist_m"))


@query("G12_under_merged", _UNDER)
def _(spark, sf):
    return places.under_merged(fx.members(spark, sf))


@query(
    "G12_alias_candidates",
    f"""SELECT place_id_a, place_id_b, name_a, name_b, round(gap, 3) AS gap_m, round({haversine_sql("p.lat_centroid", "p.lon_centroid", "q.lat_centroid", "q.lon_centroid")}, 3) AS centroid_gap_m FROM (
  SELECT a.place_id AS place_id_a, b.place_id AS place_id_b, a.name_norm AS name_a, b.name_norm AS name_b, min({haversine_sql("a.lat", "a.lon", "b.lat", "b.lon")}) AS gap
  FROM members a JOIN members b ON a.place_id < b.place_id AND a.name_norm <> b.name_norm AND abs(a.lat - b.lat) < 0.001 AND {haversine_sql("a.lat", "a.lon", "b.lat", "b.lon")} <= 30 GROUP BY ALL) g JOIN places p ON p.place_id = place_id_a JOIN places q ON q.place_id = place_id_b""",
)
def _(spark, sf):
    m = fx.members(spark, sf)
    return places.alias_candidates(m, places.geometry(m)[0], 30.0)


# ---- 2.10 sequential operators


@query("ST1_place_overrides", "SELECT stop_id, CASE WHEN stop_id < 12 THEN 'PB_' || substr(sha1('N0|0'), 1, 8) ELSE place_id END AS place_id, stop_id < 12 AS is_override_merged FROM members")
def _(spark, sf):
    """Two merges in a chain: the second names the place that the first made."""
    ids = {r["name_norm"]: r["place_id"] for r in fx.members(spark, sf).where("stop_id in (0, 4, 8)").select("name_norm", "place_id").collect()}
    first = spark.range(1).select(names.place_id("PB", F.lit("N0"), F.lit(0)).alias("p")).first()["p"]
    rows = [{"action": "merge", "place_a": ids["N0"], "place_b": ids["N1"]}, {"action": "merge", "place_a": first, "place_b": ids["N2"]}]
    return places.apply_overrides(fx.members(spark, sf), rows)[0].select("stop_id", "place_id", "is_override_merged")


@query("ST2_hub_overrides", f"SELECT place_id, CASE WHEN name_norm = 'N5' THEN 'TERMINAL' ELSE {_CLASS} END AS hub_class, {_CLASS} AS hub_class_rule, CASE WHEN name_norm = 'N5' THEN CAST(2 AS BIGINT) END AS override_row FROM metrics")
def _(spark, sf):
    p, _, e = fx.graph(spark, sf)
    m = _metrics(spark, p, e)
    q = network.qualify(m, config.load()["hubs"]["thresholds"])
    rows = p.where("name_norm = 'N5'").select("place_id").crossJoin(spark.createDataFrame([(1, "CROSSING"), (2, "TERMINAL")], "row_no int, hub_class string"))
    return network.apply_hub_overrides(q, rows).select("place_id", "hub_class", "hub_class_rule", "override_row")


@query(
    "ST3_pattern_reconstruction",
    """SELECT pattern_id, row_number() OVER (PARTITION BY pattern_id ORDER BY stop_id) AS seq, stop_id FROM (SELECT DISTINCT pattern_id, stop_id FROM talk WHERE pattern_id IN (SELECT pattern_id FROM seqs GROUP BY 1 HAVING count(DISTINCT sequence) > 1))
UNION ALL SELECT t.pattern_id, row_number() OVER (PARTITION BY t.pattern_id ORDER BY seq), stop_id FROM talk t JOIN (SELECT min(trip_id) AS trip_id FROM seqs GROUP BY pattern_id HAVING count(DISTINCT sequence) = 1) o USING (trip_id)""",
)
def _(spark, sf):
    t = fx.talk(spark, sf)
    s = sequences.collected(t, ["trip_id", "pattern_id"], "seq", "stop_id")
    evidence = t.groupBy("pattern_id").agg(F.array_sort(F.collect_set("stop_id")).alias("stop_ids"))
    return sequences.representative(s, evidence, F.col("pattern_id") >= 0)


@query("ST4_trip_reconstruction", "SELECT trip_uid, vehicle_id, pattern_id, CAST(trip_no AS BIGINT) AS trip_no, route_name, n_events, CAST(start_seq AS BIGINT) AS start_seq, CAST(end_seq AS BIGINT) AS end_seq, CAST(start_s AS BIGINT) AS start_s, CAST(end_s AS BIGINT) AS end_s FROM log_trips")
def _(spark, sf):
    return fx.trips(spark, sf)[0].select("trip_uid", "vehicle_id", "pattern_id", "trip_no", "route_name", "n_events", "start_seq", "end_seq", "start_s", "end_s")


@query("ST5_trip_attribution", "SELECT pattern_id * 10 AS trip_id, pattern_id, split_part(route, '지원', 1) AS route, role, CASE WHEN role = 'support' THEN 'support' ELSE 'tagged' END AS attribution FROM joined")
def _(spark, sf):
    p = canonical.join_tags(*fx.tagged(spark, sf), "지원")
    return canonical.attribute_trips(p.select((F.col("pattern_id") * 10).alias("trip_id"), "pattern_id"), p, "지원")


@query("ST6_route_classes", "SELECT route, CASE WHEN regexp_full_match(route, '\\d{4}') THEN 'express' WHEN contains(route, '지원') THEN 'support' ELSE 'general' END AS route_class FROM (SELECT DISTINCT route FROM patterns)")
def _(spark, sf):
    routes = fx.tagged(spark, sf)[0].select("route").distinct()
    return canonical.classify_routes(routes, config.rules("planned"), check_counts=False).select("route", "route_class")


# ---- 2.12 checks


@query(
    "CK_primitives",
    """SELECT 'unique_pass' AS id, CAST((SELECT count(*) - count(DISTINCT o_orderkey) FROM orders) AS BIGINT) AS n
UNION ALL SELECT 'unique_fail', (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
UNION ALL SELECT 'dangling', (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'functional', (SELECT count(*) FROM (SELECT n_nationkey FROM nation GROUP BY 1 HAVING count(DISTINCT n_regionkey) > 1))
UNION ALL SELECT 'enum', (SELECT count(DISTINCT event_type) FROM events WHERE event_type NOT IN ('error', 'click', 'view', 'signup'))
UNION ALL SELECT 'range', (SELECT count(*) FROM lineitem WHERE l_discount < 0 OR l_discount >= 0.1)
UNION ALL SELECT 'large', (SELECT count(*) FROM lineitem WHERE l_quantity > 45)
UNION ALL SELECT 'order', (SELECT count(*) FROM (SELECT l_partkey - lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS d FROM lineitem) WHERE d <= 0)
UNION ALL SELECT 'functional_fail', (SELECT count(*) FROM (SELECT n_regionkey FROM nation GROUP BY 1 HAVING count(DISTINCT n_nationkey) > 1))
UNION ALL SELECT 'regex', (SELECT count(*) FROM customer WHERE NOT regexp_full_match(c_name, 'Customer#\\d{9}'))
UNION ALL SELECT 'regex_fail', (SELECT count(*) FROM customer WHERE NOT regexp_full_match(c_name, 'Customer#0{7}\\d{2}'))""",
)
def _(spark, sf):
    t = lambda n: fx.table(spark, sf, n)
    audits = (
        primitives.Audit(t("orders")).table(
            unique_pass=primitives.repeated_rows(t("orders"), ["o_orderkey"]),
            dangling=primitives.dangling_values(t("orders"), "o_custkey", t("customer"), "c_custkey"),
        ),
        primitives.Audit(t("lineitem")).row(range=primitives.not_within("l_discount", 0, 0.1, open_end=True), large=F.col("l_quantity") > 45).table(
            unique_fail=primitives.repeated_rows(t("lineitem"), ["l_orderkey", "l_linenumber"]),
            order=primitives.order_violations(t("lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"], "l_partkey"),
        ),
        primitives.Audit(t("nation")).table(functional=primitives.dependency_violations(t("nation"), "n_nationkey", "n_regionkey"), functional_fail=primitives.dependency_violations(t("nation"), "n_regionkey", "n_nationkey")),
        primitives.Audit(t("events")).table(enum=primitives.values(t("events"), "event_type", primitives.not_among("event_type", ["error", "click", "view", "signup"]))),
        primitives.Audit(t("customer")).row(regex=primitives.not_like("c_name", r"Customer#\d{9}"), regex_fail=primitives.not_like("c_name", r"Customer#0{7}\d{2}")),
    )
    return functools.reduce(DataFrame.unionByName, [a.counts() for a in audits])


# ---- 2.15 views beside the reference


@query("X_ranked_metrics", "SELECT place_id, rank() OVER (ORDER BY D DESC) AS rank_degree, rank() OVER (ORDER BY L DESC) AS rank_lifetime FROM metrics")
def _(spark, sf):
    p, _, e = fx.graph(spark, sf)
    return network.ranked(_metrics(spark, p, e)).select("place_id", "rank_degree", "rank_lifetime")
