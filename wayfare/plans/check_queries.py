"""Stage checks over tables with injected faults, each with the same counts in SQL.

A row per check: id, status, and what was observed as JSON.  The faulty tables
of the hub stage are one SQL text that both engines run; those of the place
stage come from the real clustering, spoilt afterwards.  Checks without an
expected value are there with status SKIP.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare import config
from wayfare.checks import contracts
from wayfare.operators import places
from wayfare.plans import fixtures as fx
from wayfare.plans.fixtures import haversine_sql
from wayfare.plans.queries import query
from wayfare.sources.scratch import Scratch


def _report(spark, stage: str, ctx: contracts.Context) -> DataFrame:
    """(check_id, status, observed) of all checks of a stage."""
    rows = [(r.check_id, r.status, None if r.observed is None else json.dumps(r.observed, sort_keys=True)) for r in contracts.run(stage, ctx)]
    return spark.createDataFrame(rows, "check_id string, status string, observed string")


def _found(check_id: str, n: str, status: str = "FAIL", fine: str = "PASS") -> str:
    """A row of SQL: ``n`` counts violations, ``status`` is what a count above 0 means."""
    return f"SELECT '{check_id}' AS check_id, CASE WHEN n = 0 THEN '{fine}' ELSE '{status}' END AS status, CAST(n AS VARCHAR) AS observed FROM (SELECT CAST(({n}) AS BIGINT) AS n)"


def _parts(check_id: str, table: str, column: str, total: str) -> str:
    """A row of SQL: rows by value as JSON, which must add up to ``total``."""
    groups = f"SELECT {column} AS g, count(*) AS n FROM {table} GROUP BY 1"
    text = "'{' || string_agg('\"' || g || '\": ' || n, ', ' ORDER BY g) || '}'"
    return f"SELECT '{check_id}', CASE WHEN sum(n) = ({total}) THEN 'PASS' ELSE 'FAIL' END, {text} FROM ({groups})"


# ---- S03: metrics, edges and classes made from part numbers, the faults by remainders

_HUB_TABLES = {
    "places": "SELECT concat('p', p_partkey) AS place_id FROM part",
    "place_metrics": """SELECT place_id, name_norm, D, CASE WHEN k % 101 = 3 THEN D + 1 ELSE A END AS A, CASE WHEN k % 113 = 7 AND k % 50 <> 5 THEN NULL WHEN k % 103 = 4 THEN 11 ELSE L END AS L,
  CASE WHEN k % 107 = 5 THEN L + 1 WHEN D >= 3 THEN L ELSE 0 END AS L_star, CASE WHEN k % 109 = 6 THEN D < 1 ELSE D >= 1 END AS in_lspace
  FROM (SELECT p_partkey AS k, concat('p', p_partkey) AS place_id, concat('N', p_partkey % 50) AS name_norm, p_partkey % 9 AS D, least(p_partkey % 9, 1 + p_partkey % 4) AS A,
    CASE WHEN p_partkey % 9 = 0 THEN 0 ELSE 1 + p_partkey % 10 END AS L FROM part
    UNION ALL SELECT p_partkey, concat('p', p_partkey), concat('N', p_partkey % 50), p_partkey % 9, least(p_partkey % 9, 1 + p_partkey % 4),
    CASE WHEN p_partkey % 9 = 0 THEN 0 ELSE 1 + p_partkey % 10 END FROM part WHERE p_partkey % 131 = 9) x WHERE k % 127 <> 8""",
    "hub_qualification": """SELECT place_id, rule AS hub_class_rule, CASE WHEN k % 89 = 2 THEN 'CROSSING' ELSE rule END AS hub_class, k % 5 = 0 AND k % 89 = 2 AS is_override,
  CASE WHEN k % 83 = 3 THEN 1 WHEN k % 5 = 0 AND k % 89 = 2 THEN 2 END AS override_row
  FROM (SELECT p_partkey AS k, concat('p', p_partkey) AS place_id, CASE WHEN p_partkey % 97 = 1 THEN 'TERMINAL' WHEN p_partkey % 9 >= 3 AND least(p_partkey % 9, 1 + p_partkey % 4) >= 3 THEN 'CROSSING'
    WHEN p_partkey % 9 >= 5 AND 1 + p_partkey % 4 <= 2 AND 1 + p_partkey % 10 >= 5 THEN 'TERMINAL' ELSE 'NONE' END AS rule FROM part) x WHERE k % 137 <> 10""",
    "l_space_place_edges": """SELECT concat('p', k) AS place_a, concat('p', k + 1) AS place_b, 1 + k % 5 AS n_patterns, 1 + k % 3 AS n_routes,
  CASE WHEN k % 59 = 4 THEN 'r1' WHEN k % 3 = 0 THEN 'r0' WHEN k % 3 = 1 THEN 'r0|r1' ELSE concat('r0|r1|r', k % 40) END AS routes, k * 37 % 16000 AS gap_m
  FROM (SELECT p_partkey AS k FROM part UNION ALL SELECT p_partkey FROM part WHERE p_partkey % 61 = 5) x""",
    "route_catalog": "SELECT DISTINCT concat('r', p_partkey % 40) AS route, CASE WHEN p_partkey % 8 = 7 THEN 'express' ELSE 'general' END AS route_class FROM part",
    "sensitivity": "SELECT n_nationkey % 2 = 0 AS is_adopted, 0 AS n_crossing, 0 AS n_terminal FROM nation",
    "diag_lspace_gap": "SELECT CASE WHEN p_partkey % 4 = 0 THEN 'not_in_universe' ELSE 'filtered' END AS reason FROM part WHERE p_partkey % 9 = 0",
}
_METRIC_CLASS = "CASE WHEN D >= 3 AND A >= 3 THEN 'CROSSING' WHEN D >= 5 AND A <= 2 AND L_star >= 5 THEN 'TERMINAL' ELSE 'NONE' END"
_CLASSED = "SELECT count(*) FROM place_metrics JOIN hub_qualification USING (place_id) WHERE"
_DIFF = {"fine": "MATCH", "status": "UNEXPLAINED"}
_HUB_CHECKS = (
    _found(
        "C-S03-B-001",
        "SELECT (SELECT count(*) FROM place_metrics ANTI JOIN places USING (place_id)) + (SELECT count(*) FROM places ANTI JOIN place_metrics USING (place_id)) + (SELECT count(*) - count(DISTINCT place_id) FROM place_metrics) + (SELECT count(*) FROM place_metrics WHERE D IS NULL OR A IS NULL OR L IS NULL)",
    ),
    _found("C-S03-B-002", "SELECT count(*) FROM place_metrics WHERE L_star <> CASE WHEN D >= 3 THEN L ELSE 0 END"),
    _found("C-S03-B-003", f"{_CLASSED} hub_class_rule <> {_METRIC_CLASS}"),
    _found("C-S03-B-004", "SELECT count(*) FROM place_metrics WHERE A > D"),
    _found(
        "C-S03-B-005",
        """SELECT (SELECT count(*) FROM ((SELECT place_a FROM l_space_place_edges UNION SELECT place_b FROM l_space_place_edges) EXCEPT SELECT place_id FROM places))
  + (SELECT count(*) FROM l_space_place_edges WHERE place_a >= place_b OR n_routes > n_patterns OR n_routes <> len(string_split(routes, '|')))
  + (SELECT count(*) FROM (SELECT unnest(string_split(routes, '|')) FROM l_space_place_edges EXCEPT SELECT route FROM route_catalog WHERE route_class IN ('general', 'ulju')))
  + (SELECT count(*) - count(DISTINCT (place_a, place_b)) FROM l_space_place_edges)""",
    ),
    _found("C-S03-B-006", "SELECT count(*) FROM place_metrics WHERE L < 0 OR L > 10 OR (D = 0 AND (A <> 0 OR L <> 0)) OR (D > 0) <> in_lspace OR (D > 0 AND A < 1)"),
    "SELECT 'C-S03-B-007', 'FAIL', '{\"adopted\": ' || count(*) FILTER (is_adopted) || ', \"rows\": ' || count(*) || '}' FROM sensitivity",
    """SELECT 'C-S03-B-008', CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END, '{"applied": ' || n || ', "bad": ' || bad || '}' FROM (SELECT count(*) FILTER (is_override) AS n,
  count(*) FILTER (is_override <> (override_row IS NOT NULL) OR (NOT is_override AND hub_class <> hub_class_rule)) AS bad FROM hub_qualification)""",
    _parts("C-S03-B-009", "hub_qualification", "hub_class", "SELECT count(*) FROM places"),
    _parts("C-S03-B-010", "diag_lspace_gap", "reason", "SELECT count(*) FROM place_metrics WHERE D = 0"),
    _found("P-S03-B-001", "SELECT count(*) FROM l_space_place_edges WHERE gap_m > 15000"),
    _found("D-S03-B-001", f"{_CLASSED} hub_class_rule <> 'NONE'", **_DIFF),
    _found("D-S03-B-002", f"{_CLASSED} hub_class_rule = 'CROSSING'", **_DIFF),
    _found("D-S03-B-003", f"{_CLASSED} hub_class_rule = 'TERMINAL'", **_DIFF),
    _found("D-S03-B-004", f"{_CLASSED} D <= 2", **_DIFF),
    _found("D-S03-B-005", f"{_CLASSED} D = 2", **_DIFF),
    """SELECT 'D-S03-B-006', CASE WHEN far = 0 THEN 'MATCH' ELSE 'UNEXPLAINED' END, '{"N5": {"A": ' || A || ', "D": ' || D || ', "L": ' || L || '}}' FROM (
  SELECT abs(D - 4) + abs(A - 2) + abs(L - 3) AS far, D, A, L FROM place_metrics WHERE name_norm = 'N5' ORDER BY far, D, A, L LIMIT 1)""",
)


def _within(tables: dict[str, str], checks: tuple[str, ...]) -> str:
    """The checks over tables of their own names.  They shadow the tables that other queries share, so nothing else is put in front."""
    given = ",\n".join(f"{name} AS MATERIALIZED ({text})" for name, text in tables.items())
    return f"WITH {given}\n" + "\nUNION ALL ".join(checks)


@query("CK_S03_checks", _within(_HUB_TABLES, _HUB_CHECKS), shared=False)
def _(spark, sf):
    """All checks of the hub stage."""
    for name in ("part", "nation"):
        fx.table(spark, sf, name).createOrReplaceTempView(f"ck_{name}")
    tables = {k: spark.sql(v.replace("FROM part", "FROM ck_part").replace("FROM nation", "FROM ck_nation")) for k, v in _HUB_TABLES.items()}
    parts = {"crossing": 0, "terminal": 0, "peripheral_d_le_2": 0, "d_eq_2": 0}
    baseline = {"planned": {"hub": {"qualified": 0, "decomposition": parts, "spot": {"N5": {"D": 4, "A": 2, "L": 3}}}}}
    return _report(spark, "S03", contracts.Context(tables, config.load(), baseline=baseline))


# ---- S02: the clustering with joined and torn names, its tables spoilt once more

_NAME = "CAST(substr(name_norm, 2) AS BIGINT)"
_H = haversine_sql("a.lat", "a.lon", "b.lat", "b.lon")
_PLACE_TABLES = {
    "true_places": f"""SELECT i.place_id, min(name_norm) AS name_norm, count(*) AS n_stops, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, coalesce(any_value(span), 0) AS span_m FROM injured i
  LEFT JOIN (SELECT a.place_id, max({_H}) AS span FROM injured a JOIN injured b ON a.place_id = b.place_id AND a.stop_id < b.stop_id GROUP BY 1) s ON s.place_id = i.place_id GROUP BY 1""",
    "s_places": f"""SELECT place_id, name_norm, CASE WHEN {_NAME} % 13 = 5 THEN name_norm || '?' ELSE name_norm END AS place_name, n_stops, lat + CASE WHEN {_NAME} % 11 = 4 THEN 0.001 ELSE 0 END AS lat, lon,
  span_m + CASE WHEN {_NAME} % 17 = 6 THEN 1 ELSE 0 END AS span_m, {_NAME} % 29 = 7 AS merged FROM true_places""",
    "s_map": """SELECT stop_id, place_id, CASE WHEN stop_id % 89 = 1 THEN name_norm || 'x' ELSE name_norm END AS name_norm FROM injured WHERE stop_id % 97 <> 5
  UNION ALL SELECT stop_id, place_id, name_norm FROM injured WHERE stop_id % 79 = 3""",
    "s_under": f"""SELECT CASE WHEN {_NAME} % 7 = 2 THEN q ELSE p END AS pa, CASE WHEN {_NAME} % 7 = 2 THEN p ELSE q END AS pb, name_norm
  FROM (SELECT a.place_id AS p, b.place_id AS q, a.name_norm FROM true_places a JOIN true_places b ON a.name_norm = b.name_norm AND a.place_id < b.place_id)""",
    "s_plain": "SELECT m.stop_id, m.place_id, m.name_norm, s.lat, s.lon FROM s_map m JOIN s_places p ON p.place_id = m.place_id AND NOT p.merged JOIN stops s ON s.stop_id = m.stop_id",
    "s_near": f"SELECT DISTINCT a.place_id, a.stop_id AS u, b.stop_id AS v FROM s_plain a JOIN s_plain b ON a.place_id = b.place_id AND a.stop_id <> b.stop_id AND {_H} <= 150",
    "s_walk": "SELECT stop_id AS u, stop_id AS v FROM s_plain UNION SELECT w.u, n.v FROM s_walk w JOIN s_near n ON n.u = w.v",
    "s_again": f"""SELECT m.place_id, count(*) AS n_stops, round(avg(s.lat), 6) AS lat, round(avg(s.lon), 6) AS lon, coalesce(any_value(span), 0) AS span_m FROM s_map m JOIN stops s USING (stop_id)
  LEFT JOIN (SELECT place_id, max({_H.replace("a.l", "sa.l").replace("b.l", "sb.l")}) AS span FROM s_map x JOIN s_map y USING (place_id) JOIN stops sa ON sa.stop_id = x.stop_id JOIN stops sb ON sb.stop_id = y.stop_id
    WHERE x.stop_id < y.stop_id GROUP BY 1) d ON d.place_id = m.place_id GROUP BY 1""",
}
_PLACE_CHECKS = (
    _found("C-S02-B-001", "SELECT (SELECT count(*) FROM stops ANTI JOIN s_map USING (stop_id)) + (SELECT count(*) - count(DISTINCT stop_id) FROM s_map)"),
    _found("C-S02-B-002", "SELECT count(*) FROM (SELECT place_id FROM s_map JOIN s_places p USING (place_id) WHERE NOT merged GROUP BY 1 HAVING count(DISTINCT s_map.name_norm) > 1)"),
    _found("C-S02-B-003", "SELECT count(*) FROM s_places p JOIN (SELECT place_id, min(stop_id) AS least FROM s_map GROUP BY 1) l USING (place_id) WHERE 'PB_' || substr(sha1(place_name || '|' || least), 1, 8) <> place_id"),
    _found(
        "C-S02-B-004",
        f"""SELECT (SELECT count(*) FROM (SELECT place_id FROM s_plain JOIN (SELECT u, min(v) AS label FROM s_walk GROUP BY 1) l ON l.u = stop_id GROUP BY 1 HAVING count(DISTINCT label) > 1))
  + (SELECT count(*) FROM (SELECT DISTINCT x.name_norm, x.place_id AS pa, y.place_id AS pb FROM s_plain x JOIN s_plain y ON x.name_norm = y.name_norm AND x.place_id < y.place_id) t
    JOIN (SELECT a.place_id AS pa, b.place_id AS pb FROM s_plain a JOIN s_plain b ON a.place_id < b.place_id AND abs(a.lat - b.lat) < 0.002 GROUP BY 1, 2 HAVING round(min({_H}), 3) <= 150) g USING (pa, pb))""",
    ),
    """SELECT 'C-S02-B-005', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, '{"merged_places": ' || n || ', "rows": 0}' FROM (SELECT count(*) AS n FROM s_places WHERE merged)""",
    """SELECT 'C-S02-B-006', 'FAIL', '{"1": ' || count(*) FILTER (n = 1) || ', "2": ' || count(*) FILTER (n = 2) || ', "3+": ' || count(*) FILTER (n > 2) || '}' FROM (SELECT count(*) AS n FROM s_map GROUP BY name_norm)""",
    f"""SELECT 'C-S02-B-007', CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END, '{{"bad": ' || bad || ', "pairs": ' || n || '}}' FROM (SELECT count(*) FILTER (pa >= pb) + count(*) FILTER (pa >= pb OR {_NAME} % 5 = 0) AS bad, count(*) AS n FROM s_under)""",
    _found("C-S02-B-008", f"SELECT count(*) FROM s_places a JOIN s_again b USING (place_id) WHERE {_H} > 0.5 OR abs(a.span_m - b.span_m) > 0.5 OR a.n_stops <> b.n_stops"),
    _found("P-S02-B-001", "SELECT count(*) FROM s_places WHERE span_m > 300"),
    _found("D-S02-B-001", "SELECT count(*) FROM s_places", **_DIFF),
    _found("D-S02-B-002", "SELECT count(*) FROM s_under", **_DIFF),
    "SELECT 'D-S02-B-003', 'SKIP', NULL",
)


@query("CK_S02_checks", "\nUNION ALL ".join(_PLACE_CHECKS), more=_PLACE_TABLES)
def _(spark, sf):
    """All checks of the place stage; one metric has no baseline."""
    number = F.substring("name_norm", 2, 20).cast("long")
    scratch = Scratch(spark, "checks")
    m = scratch.put(fx.injured(spark, sf), "members")
    table, mapped = (scratch.put(df, name) for df, name in zip(places.geometry(m), ("places", "map"), strict=True))
    faults = {
        "place_name": F.when(number % 13 == 5, F.concat("name_norm", F.lit("?"))).otherwise(F.col("name_norm")),
        "lat_centroid": F.col("lat_centroid") + F.when(number % 11 == 4, 0.001).otherwise(0.0),
        "span_m": F.col("span_m") + F.when(number % 17 == 6, 1.0).otherwise(0.0),
        "is_override_merged": number % 29 == 7,
    }
    twice = mapped.where("stop_id % 79 = 3")
    renamed = F.when(F.col("stop_id") % 89 == 1, F.concat("name_norm", F.lit("x"))).otherwise(F.col("name_norm"))
    under = scratch.put(places.under_merged(m), "under")
    a, b, swapped = F.col("place_id_a"), F.col("place_id_b"), number % 7 == 2
    under = under.withColumns({"place_id_a": F.when(swapped, b).otherwise(a), "place_id_b": F.when(swapped, a).otherwise(b)})
    other = F.when(number % 5 == 0, F.col("name_norm")).otherwise(F.concat("name_norm", F.lit("y")))
    tables = {
        "stops": fx.stops(spark, sf),
        "places": table.withColumns(faults),
        "stop_place_map": mapped.where("stop_id % 97 <> 5").withColumn("name_norm", renamed).unionByName(twice),
        "override_applied": spark.createDataFrame([], "row_no int"),
        "diag_under_merge": under,
        "diag_alias": under.select("place_id_a", "place_id_b", F.col("name_norm").alias("name_a"), other.alias("name_b"), F.lit(10.0).alias("gap_m")),
    }
    expect = {"C-S02-B-006": {"1": 0, "2": 0, "3+": 0}}
    baseline = {"planned": {"place": {"total": 0, "diag": {"under_merge_candidates": 0}}}}
    return _report(spark, "S02", contracts.Context(tables, config.load(), expect=expect, baseline=baseline))
