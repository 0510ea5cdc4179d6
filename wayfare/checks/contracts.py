"""The checks of every stage, by id.

Audited numbers of a delivery (row counts, known anomalies, class sizes) are
``expect`` entries by check id; a check that only compares with such a number
is skipped without one.  A positive control must find its anomaly: without it,
it fails, and so it does when a known anomaly is gone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.checks import judge as judging
from wayfare.checks import lint, primitives
from wayfare.checks.primitives import Result, record
from wayfare.functions import geo, names
from wayfare.operators import joins, network, places, sequences


@dataclass
class Context:
    """What checks may read: declared tables only, each cached once."""

    tables: dict[str, DataFrame]
    params: dict
    rules: dict = field(default_factory=dict)
    expect: dict = field(default_factory=dict)
    meta: dict = field(default_factory=dict)
    scope: str = "planned"
    baseline: dict = field(default_factory=dict)
    deviations: list = field(default_factory=list)
    notes: Path | None = None
    held: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise KeyError(f"{name} is not among the declared inputs {sorted(self.tables)}")
        if name not in self.held:
            self.held[name] = self.tables[name].cache()
        return self.held[name]

    def release(self) -> None:
        for df in self.held.values():
            df.unpersist()
        self.held.clear()


Check = Callable[[Context, str], Result | None]
STAGES: dict[tuple[str, str], dict[str, tuple[str, Check]]] = {}


def check(stage: str, scopes: str, number: str, check_class: str = "CONTRACT"):
    def register(f: Check) -> Check:
        for scope in scopes.split():
            letter = {"planned": "B", "actual": "A"}[scope]
            kind = {"CONTRACT": "C", "PHYSICAL": "P", "DIFF": "D"}[check_class]
            STAGES.setdefault((stage, scope), {})[f"{kind}-{stage}-{letter}-{number}"] = (check_class, f)
        return f

    return register


def run(stage: str, ctx: Context) -> list[Result]:
    """All checks of a stage; an error inside one is a failure of it, not of the run."""
    out = []
    try:
        for cid, (cls, f) in STAGES.get((stage, ctx.scope), {}).items():
            try:
                r = f(ctx, cid)
            except (KeyError, ValueError, TypeError) as e:
                r = Result(cid, cls, "FAIL", f"{type(e).__name__}: {e}", None)
            out.append(r if r is not None else Result(cid, cls, "SKIP", None, None, note="no expected value"))
    finally:
        ctx.release()
    return out





def _expected(ctx: Context, cid: str, observed, cls: str = "CONTRACT", **more) -> Result | None:
    return record(cid, cls, observed, ctx.expect[cid], **more) if cid in ctx.expect else None


def _zero(cid: str, n, cls: str = "CONTRACT", **more) -> Result:
    return record(cid, cls, n, 0, n == 0, **more)


def _adds_up(cid: str, parts: dict[str, int], total: int) -> Result:
    """Parts that together are the whole: which of them leaks is read off the parts."""
    return record(cid, "CONTRACT", parts, {"total": total}, sum(parts.values()) == total)


def _count(df: DataFrame) -> int:
    return df.count()


def _one(df: DataFrame, *columns) -> tuple:
    return tuple(df.agg(*columns).first())


# ---- S00 ingest


@check("S00", "planned actual", "000")
def _(c, cid):
    """Raw inputs have the hashes that were audited."""
    want, have = c.expect.get("raw_hashes"), c.meta.get("raw_hashes")
    return None if not want else record(cid, "CONTRACT", have, want, all((have or {}).get(k) == v for k, v in want.items()))


@check("S00", "planned", "001")
def _(c, cid):
    return record(cid, "CONTRACT", "column names", "no byte order mark", not any(x.startswith("﻿") for t in c.tables.values() for x in t.columns))


@check("S00", "planned", "002")
def _(c, cid):
    return _expected(c, cid, {"rows": _count(c["stop_times"])})


@check("S00", "planned", "003")
def _(c, cid):
    return primitives.clean(cid, "CONTRACT", primitives.repeated_rows(c["stop_times"], ["trip_id", "seq"]))


@check("S00", "planned", "004")
def _(c, cid):
    a, b, s = _one(c["stop_times"], F.countDistinct("trip_id"), F.countDistinct("pattern_id"), F.countDistinct("stop_id"))
    return _expected(c, cid, {"trips": a, "patterns": b, "stops": s})


@check("S00", "planned", "005")
def _(c, cid):
    bad = c["trips"].where(F.regexp_replace("trip_id", r"_Ord\d{3}$", "") != F.col("pattern_id"))
    two = primitives.dependency_violations(c["stop_times"], "trip_id", "pattern_id").first()[0]
    return _zero(cid, _count(bad) + two)


@check("S00", "planned", "006")
def _(c, cid):
    from wayfare.sources import loaders

    wrong = {k: F.count_if(primitives.not_like(k, p)) for k, p in (("pattern_id", loaders.ROUTE_ID), ("stop_id", loaders.STOP_ID))}
    n = sum(primitives.gauges(c["stop_times"], **wrong).values())
    return _zero(cid, n)


def _times(c) -> dict:
    t = c.params["time"]
    w = Window.partitionBy("trip_id").orderBy("seq")
    s = c["stop_times"].withColumn("next", F.lead("arr_s").over(w)).withColumn("first", F.row_number().over(w) == 1)
    inside = lambda x: F.col(x).between(t["first_hour"] * 3600, t["last_hour"] * 3600 - 1)
    return primitives.gauges(s, window=F.count_if(~inside("arr_s") | ~inside("dep_s")), negative_dwell=F.count_if(F.col("dep_s") < F.col("arr_s")), overtaken=F.count_if(F.col("next") < F.col("dep_s")), first=F.count_if(F.col("first") & (F.col("arr_s") != F.col("dep_s"))), long_dwell=F.count_if(F.col("dep_s") - F.col("arr_s") > 600))


@check("S00", "planned", "007")
def _(c, cid):
    g = _times(c)
    g.pop("long_dwell")
    return record(cid, "CONTRACT", g, dict.fromkeys(g, 0), not any(g.values()))


@check("S00", "planned", "008")
def _(c, cid):
    return _expected(c, cid, _times(c)["long_dwell"], positive_control=True)


@check("S00", "planned", "009")
def _(c, cid):
    g = c["stop_times"].groupBy("trip_id").agg(F.min("seq").alias("a"), F.max("seq").alias("b"), F.count(F.lit(1)).alias("n"))
    offset, gap = _one(g, F.count_if((F.col("a") != 1) & (F.col("b") - F.col("a") + 1 == F.col("n"))), F.count_if(F.col("b") - F.col("a") + 1 != F.col("n")))
    return _expected(c, cid, {"offset": offset, "gap": gap}, positive_control=True)


@check("S00", "planned", "010")
def _(c, cid):
    s = sequences.collected(c["stop_times"], ["trip_id", "pattern_id"], "seq", "stop_id")
    many = sequences.distinct_sequences(s, "pattern_id").where("n_sequences > 1 and not startswith(pattern_id, 'BR_ACC0_')")
    return _zero(cid, _count(many))


@check("S00", "planned", "011")
def _(c, cid):
    return primitives.clean(cid, "CONTRACT", primitives.dangling_values(c["stop_times"], "stop_id", c["stops"], "stop_id"))


@check("S00", "planned", "012")
def _(c, cid):
    return primitives.clean(cid, "CONTRACT", primitives.repeated_rows(c["stops"], ["stop_id"]))


@check("S00", "planned", "013")
def _(c, cid):
    alias, far = _one(c["join_resolved"], F.count_if("via_alias"), F.max("dist_m"))
    fails, limit = _count(c["join_failures"]), c.params["resolve"]["max_dist_m"]
    want = c.expect.get(cid, {"alias": alias})
    return record(cid, "CONTRACT", {"alias": alias, "failures": fails, "max_m": far}, {**want, "failures": 0, "max_m": limit}, fails == 0 and alias == want["alias"] and (far or 0) <= limit, positive_control="alias" in c.expect.get(cid, {}))


@check("S00", "planned", "014")
def _(c, cid):
    u = c["route_union"]
    g = u.groupBy("route_name").agg(F.min("seq").alias("a"), F.max("seq").alias("b"), F.count(F.lit(1)).alias("n"))
    lists = _count(u.where((F.size("arr_list_s") != F.col("도착횟수")) | F.exists("arr_list_s", lambda x: x.isNull())))
    return _zero(cid, _count(g.where("a <> 1 or b <> n")) + lists)


def _cells(c) -> DataFrame:
    """Arrivals per (route name, stop): timetable against the listed times, each side counted."""
    st = c["stop_times"].groupBy("route_name", "stop_id").agg(F.count(F.lit(1)).alias("n"))
    ru = c["route_union"].groupBy("route_name", "stop_id").agg(F.sum("도착횟수").alias("n"))
    return joins.reconcile(st, ru, ["route_name", "stop_id"], F.col("n"), F.col("n"))


@check("S00", "planned", "015")
def _(c, cid):
    g = {r["status"]: r["count"] for r in _cells(c).groupBy("status").count().collect()}
    off = sum(v for k, v in g.items() if k != "equal")
    return record(cid, "CONTRACT", off, c.expect.get(cid, 0), note=str(g))


@check("S00", "planned", "016")
def _(c, cid):
    t = c["variant_tags"]
    lost = _count(primitives.dangling_values(t, "base_id", t, "pattern_id")) + _count(primitives.dangling_values(t, "pattern_id", c["trips"], "pattern_id"))
    return _zero(cid, lost + primitives.repeated_rows(t, ["pattern_id"]).first()[0])


@check("S00", "planned", "017")
def _(c, cid):
    """Evidence names every tagged pattern, with stops that are there."""
    e = c["evidence"]
    lost = _count(primitives.dangling_values(c["variant_tags"], "pattern_id", e, "pattern_id"))
    stops = _count(primitives.dangling_values(e.select(F.explode("stop_ids").alias("s")), "s", c["stops"], "stop_id"))
    return _zero(cid, lost + stops)


@check("S00", "planned actual", "018")
def _(c, cid):
    """No column has a judging name."""
    return lint.check_names(cid, sorted({x for t in c.tables.values() for x in t.columns}))


@check("S00", "planned actual", "001", "PHYSICAL")
def _(c, cid):
    bad = _count(c["stops"].where(~geo.in_box(F.col("lat"), F.col("lon"), c.params["coordinates"])))
    return _zero(cid, bad, "PHYSICAL")


@check("S00", "planned", "001", "DIFF")
def _(c, cid):
    n = _count(c["stop_times"].select(names.base_name(F.col("route_name"))).distinct())
    return _judge(c, cid, n, "planned.routes")


def _judge(c: Context, cid: str, observed, key: str) -> Result | None:
    try:
        judging.lookup(c.baseline, key)
    except (KeyError, TypeError):
        return None
    return judging.judge(cid, observed, key, c.baseline, c.deviations, c.params["checks"]["tolerance"], c.notes)


@check("S00", "actual", "001")
def _(c, cid):
    return _expected(c, cid, _count(c["events"]))


@check("S00", "actual", "002")
def _(c, cid):
    return record(cid, "CONTRACT", _one(c["events"], F.countDistinct("service_date"))[0], 1)


@check("S00", "actual", "003")
def _(c, cid):
    return _zero(cid, _count(c["events"].where("arr_ts is null")))


@check("S00", "actual", "004")
def _(c, cid):
    n, bad = _one(c["events"], F.count_if("dep_is_sentinel"), F.count_if(F.col("dep_is_sentinel") & F.col("dep_s").isNotNull()))
    return record(cid, "CONTRACT", {"sentinels": n, "with_time": bad}, {"sentinels": c.expect.get(cid, n), "with_time": 0}, bad == 0 and n == c.expect.get(cid, n), positive_control=cid in c.expect)


@check("S00", "actual", "005")
def _(c, cid):
    n = _one(c["events"], F.count_if(F.col("arr_s").isNull() | (~F.col("dep_is_sentinel") & F.col("dep_s").isNull())))[0]
    return _zero(cid, n)


@check("S00", "actual", "006")
def _(c, cid):
    many = c["route_master"].groupBy("pattern_id", "master_seq").agg(F.countDistinct("stop_id").alias("k")).where("k > 1")
    return _zero(cid, _count(many))


@check("S00", "actual", "007")
def _(c, cid):
    return primitives.clean(cid, "CONTRACT", primitives.repeated_rows(c["events"], ["obe_id", "pattern_id", "master_seq", "arr_ts"]))


@check("S00", "actual", "008")
def _(c, cid):
    a = _count(primitives.dangling_values(c["events"], "stop_id", c["stops"], "stop_id"))
    b = _count(primitives.dangling_values(c["route_agg"], "stop_id", c["stops"], "stop_id"))
    unused = _count(primitives.dangling_values(c["stops"], "stop_id", c["events"], "stop_id"))
    return record(cid, "CONTRACT", {"lost": a + b, "unused": unused}, {"lost": 0}, a + b == 0 and unused == c.expect.get(cid, unused))


@check("S00", "actual", "009")
def _(c, cid):
    n, k = _one(c["events"].where("route_name is null"), F.count(F.lit(1)), F.countDistinct("pattern_id"))
    return _expected(c, cid, {"rows": n, "patterns": k})


@check("S00", "actual", "010")
def _(c, cid):
    """Arrivals per pattern and stop: the log against its own aggregate."""
    ev = c["events"].groupBy("pattern_id", "stop_id").agg(F.count(F.lit(1)).alias("n"))
    ag = c["route_agg"].groupBy("pattern_id", "stop_id").agg(F.sum("도착횟수").alias("n"))
    off = _count(joins.reconcile(ev, ag, ["pattern_id", "stop_id"], F.col("n"), F.col("n")).where("status <> 'equal'"))
    return record(cid, "CONTRACT", off, c.expect.get(cid, 0))


@check("S00", "actual", "011")
def _(c, cid):
    return _zero(cid, _count(c["route_agg"].where(F.exists("arr_list_s", lambda x: x.isNull()) | (F.size("arr_list_s") != F.col("도착횟수")))))


# ---- S01 canonical


@check("S01", "planned", "001")
def _(c, cid):
    """Every pattern's sequence is one that its trips have, unless it varies."""
    s = sequences.collected(c["stop_times"], ["trip_id", "pattern_id"], "seq", "stop_id").select("pattern_id", names.sequence_key(F.col("sequence")).alias("pattern_key")).distinct()
    fixed = c["patterns"].where("not is_drt").select("pattern_id", "pattern_key")
    return _zero(cid, _count(fixed.join(s, ["pattern_id", "pattern_key"], "left_anti")))


@check("S01", "planned", "002")
def _(c, cid):
    lost = _count(primitives.dangling_values(c["variant_tags"], "pattern_id", c["patterns"], "pattern_id"))
    untagged = c["patterns"].join(c["variant_tags"].select("pattern_id"), "pattern_id", "left_anti")
    return _zero(cid, lost + _count(untagged.where("role <> 'support'")))


@check("S01", "planned", "003")
def _(c, cid):
    p = c["patterns"]
    own = F.col("base_pattern_id_raw") == F.col("pattern_id")
    main, circular, left = _one(p, F.count_if((F.col("role") == "main") & own), F.count_if((F.col("role") == "circular") & own & (F.col("base_ref") == F.col("pattern_id"))), F.count_if((F.col("role") == "main") & (F.col("base_ref") == F.col("pattern_id"))))
    seen = {"main_self": main, "circular_self_kept": circular}
    return record(cid, "CONTRACT", seen, c.expect.get(cid, seen), left == 0 and seen == c.expect.get(cid, seen))


@check("S01", "planned", "004")
def _(c, cid):
    """The canonical rows are main, circular without base, short turns and branches: counted from the patterns."""
    p = c["patterns"]
    by = F.col("role").isin("main", "short_turn", "branch") | ((F.col("role") == "circular") & F.col("base_pattern_id_raw").isNull())
    n = _one(p, F.count_if(by))[0]
    rows = _count(c["canonical_rows"])
    return record(cid, "CONTRACT", {"rows": rows, "by_roles": n}, c.expect.get(cid, n), rows == n and n == c.expect.get(cid, n))


@check("S01", "planned", "005")
def _(c, cid):
    parts = {r["disposition"]: r["count"] for r in c["pattern_disposition"].groupBy("disposition").count().collect()}
    return _adds_up(cid, parts, _count(c["patterns"]))


@check("S01", "planned", "006")
def _(c, cid):
    parts = {r["attribution"]: r["count"] for r in c["trip_attribution"].groupBy("attribution").count().collect()}
    return _adds_up(cid, parts, _count(c["trips"]))


@check("S01", "planned", "007")
def _(c, cid):
    """Every route of a tagged pattern has a pattern."""
    lost = _count(primitives.dangling_values(c["trip_attribution"], "route", c["patterns"].where("role <> 'support'"), "route"))
    return _zero(cid, lost)


@check("S01", "planned", "008")
def _(c, cid):
    ps = c["pattern_stops"]
    lost = _count(primitives.dangling_values(ps, "stop_id", c["stops"], "stop_id"))
    g = ps.groupBy("pattern_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("stop_id").alias("k"), F.min_by("stop_id", "seq").alias("a"), F.max_by("stop_id", "seq").alias("b"))
    twice, closed = _one(g, F.count_if(F.col("n") > F.col("k")), F.count_if(F.col("a") == F.col("b")))
    seen = {"with_repeats": twice, "closed": closed}
    return record(cid, "CONTRACT", {**seen, "lost": lost}, c.expect.get(cid, seen), lost == 0 and seen == c.expect.get(cid, seen), positive_control=cid in c.expect)


@check("S01", "planned", "009")
def _(c, cid):
    d = c["duplicates"]
    bad = _count(d.where(F.size(F.split("routes", r"\|")) < 2))
    return record(cid, "CONTRACT", _count(d), c.expect.get(cid, _count(d)), bad == 0 and _count(d) == c.expect.get(cid, _count(d)))


@check("S01", "planned actual", "010")
def _(c, cid):
    """Every route has a class of the rules, with the expected sizes."""
    table, name = (c["route_catalog"], "route") if c.scope == "planned" else (c["route_registry"], "route_name")
    seen = {r["route_class"]: r["count"] for r in table.groupBy("route_class").count().collect()}
    known = {r["class"] for r in c.rules.get("rules", [])}
    want = c.expect.get(cid, seen)
    return record(cid, "CONTRACT", seen, want, set(seen) <= known and seen == want and primitives.repeated_rows(table, [name]).first()[0] == 0)


@check("S01", "planned", "011")
def _(c, cid):
    """Loops by tag and circular patterns by role are different things: the number that differ is known."""
    n = _count(c["patterns"].where(F.coalesce(F.col("is_loop"), F.lit(False)) != (F.col("role") == "circular")))
    return _expected(c, cid, n, positive_control=True)


@check("S01", "planned", "001", "PHYSICAL")
def _(c, cid):
    w = Window.partitionBy("pattern_id").orderBy("seq")
    r = c["pattern_stops"].join(c["stops"].select("stop_id", "lat", "lon"), "stop_id").withColumn("y", F.lead("lat").over(w)).withColumn("x", F.lead("lon").over(w))
    d = geo.haversine(F.col("lat"), F.col("lon"), F.col("y"), F.col("x"))
    return _zero(cid, _one(r, F.count_if(d > c.params["canonical"]["adjacent_gap_m"]))[0], "PHYSICAL")


@check("S01", "planned", "002", "PHYSICAL")
def _(c, cid):
    routes = c["patterns"].where("role <> 'support'").select("route").distinct()
    covered = _count(routes.join(c["backbone_stops"].select("route").distinct(), "route", "left_semi"))
    seen = {"covered": covered, "total": _count(routes)}
    return record(cid, "PHYSICAL", seen, c.expect.get(cid, seen), seen == c.expect.get(cid, seen))


@check("S01", "planned", "003", "PHYSICAL")
def _(c, cid):
    """Sequences agree with the evidence stop by stop."""
    mine = sequences.collected(c["pattern_stops"], ["pattern_id"], "seq", "stop_id")
    j = c["evidence"].join(mine, "pattern_id")
    return _zero(cid, _count(j.where(F.col("stop_ids") != F.col("sequence"))), "PHYSICAL")


for _number, _role in (("001", None), ("003", "main"), ("004", "circular"), ("005", "short_turn"), ("006", "branch")):

    @check("S01", "planned", _number, "DIFF")
    def _(c, cid, role=_role):
        if role is None:
            return _judge(c, cid, _count(c["canonical_rows"]), "planned.canonical.rows")
        return _judge(c, cid, _count(c["trip_attribution"].where(F.col("role") == role)), f"planned.canonical.trips.{role}")


@check("S01", "planned", "002", "DIFF")
def _(c, cid):
    n = {r["route_class"]: r["count"] for r in c["route_catalog"].groupBy("route_class").count().collect()}
    return _judge(c, cid, n.get("general", 0) + n.get("ulju", 0), "planned.general_routes")


@check("S01", "planned", "007", "DIFF")
def _(c, cid):
    return _judge(c, cid, _count(c["trip_attribution"].where("route is not null")) / max(1, _count(c["trips"])), "planned.trip_attribution")


@check("S01", "actual", "001")
def _(c, cid):
    """Groups plus boundaries are trips, and trips cut again from the events are the same."""
    t, e = c["trips"], c["trip_events"]
    keys = ["service_date", "obe_id", "pattern_id"]
    groups, trips = _count(t.select(keys).distinct()), _count(t)
    w = Window.partitionBy(*keys).orderBy("arr_ts", "master_seq")
    cuts = _one(e.select((F.col("master_seq") <= F.lag("master_seq").over(w)).alias("cut")), F.count_if("cut"))[0]
    return _adds_up(cid, {"groups": groups, "boundaries": cuts}, trips)


@check("S01", "actual", "002")
def _(c, cid):
    e = c["trip_events"]
    up = primitives.order_violations(e, ["trip_uid"], ["arr_ts", "master_seq"], "master_seq").first()[0]
    back = primitives.order_violations(e, ["trip_uid"], ["arr_ts", "master_seq"], "arr_s", strict=False).first()[0]
    twice = primitives.repeated_rows(c["trips"], ["trip_uid"]).first()[0]
    return _zero(cid, up + back + twice)


@check("S01", "actual", "003")
def _(c, cid):
    rate = _one(c["trips"], F.avg(F.col("is_partial").cast("int")))[0]
    return None if cid not in c.expect else record(cid, "CONTRACT", rate, c.expect[cid], abs(rate - c.expect[cid]["rate"]) <= c.expect[cid].get("tolerance", 0.02), positive_control=True)


@check("S01", "actual", "004")
def _(c, cid):
    w = Window.partitionBy("service_date", "obe_id", "pattern_id").orderBy("trip_no")
    g = c["trips"].select((F.col("start_s") - F.lag("end_s").over(w)).alias("g"))
    median = _one(g, F.percentile("g", 0.5))[0]
    low, high = c.expect.get(cid, (None, None))
    return None if low is None else record(cid, "CONTRACT", median, [low, high], low <= median <= high, positive_control=True)


@check("S01", "actual", "005")
def _(c, cid):
    trips = _count(c["trips"].where("crosses_midnight"))
    rows = _count(c["trip_events"].where("arr_s >= 86400"))
    return _expected(c, cid, {"trips": trips, "rows": rows})


@check("S01", "actual", "006")
def _(c, cid):
    r = c["pattern_registry"]
    lost = _count(primitives.dangling_values(c["trips"], "pattern_id", r, "pattern_id"))
    n, nameless, trips = _one(r, F.count(F.lit(1)), F.count_if("name_unknown"), F.sum("n_trips"))
    seen = {"patterns": n, "nameless": nameless}
    return record(cid, "CONTRACT", seen, c.expect.get(cid, seen), lost == 0 and trips == _count(c["trips"]) and seen == c.expect.get(cid, seen))


@check("S01", "actual", "007")
def _(c, cid):
    """The stop grid is passed through unchanged."""
    from wayfare.sources import sinks

    return record(cid, "CONTRACT", sinks.table_digest(c["route_master"]), c.meta.get("route_master_digest", sinks.table_digest(c["route_master"])))


@check("S01", "actual", "008")
def _(c, cid):
    return _adds_up(cid, {r["route_class"]: r["count"] for r in c["route_registry"].groupBy("route_class").count().collect()}, _one(c["pattern_registry"], F.countDistinct("route_name"))[0])


@check("S01", "actual", "009")
def _(c, cid):
    p = c["main_proposal"]
    bad = _count(p.where("(basis = 'both') <> (main_candidate <> '') or needs_review <> (basis <> 'both')"))
    lost = _count(primitives.dangling_values(c["route_registry"], "route_name", p, "route_name"))
    return _zero(cid, bad + lost)


# ---- S02 places


@check("S02", "planned actual", "001")
def _(c, cid):
    m = c["stop_place_map"]
    lost = _count(primitives.dangling_values(c["stops"], "stop_id", m, "stop_id")) + _count(primitives.dangling_values(m, "stop_id", c["stops"], "stop_id"))
    return _zero(cid, lost + primitives.repeated_rows(m, ["stop_id"]).first()[0])


@check("S02", "planned actual", "002")
def _(c, cid):
    merged = c["places"].where("not is_override_merged").select("place_id")
    g = c["stop_place_map"].join(merged, "place_id", "left_semi").groupBy("place_id").agg(F.countDistinct("name_norm").alias("k"))
    return _zero(cid, _count(g.where("k > 1")))


@check("S02", "planned actual", "003")
def _(c, cid):
    """Ids computed again from names and members."""
    prefix = {"planned": "PB", "actual": "PA"}[c.scope]
    least = c["stop_place_map"].groupBy("place_id").agg(F.min("stop_id").alias("least"))
    again = c["places"].join(least, "place_id").where(names.place_id(prefix, F.col("place_name"), F.col("least")) != F.col("place_id"))
    return _zero(cid, _count(again))


@check("S02", "planned actual", "004")
def _(c, cid):
    """Places are connected within the limit, and same-name places are farther apart."""
    limit = c.params["places"]["linkage_m"]
    plain = c["places"].where("not is_override_merged").select("place_id")
    m = c["stop_place_map"].join(plain, "place_id", "left_semi").join(c["stops"].select("stop_id", "lat", "lon"), "stop_id")
    again = places.cluster(m.select("stop_id", F.col("place_id").alias("name_norm"), "lat", "lon"), limit)
    split = _count(again.groupBy("name_norm").agg(F.countDistinct("label").alias("k")).where("k > 1"))
    close = _count(places.under_merged(m).where(F.col("gap_m") <= limit))
    return _zero(cid, split + close)


@check("S02", "planned actual", "005")
def _(c, cid):
    n, merged = _count(c["override_applied"]), _count(c["places"].where("is_override_merged"))
    want = c.meta.get("n_overrides", n)
    return record(cid, "CONTRACT", {"rows": n, "merged_places": merged}, {"rows": want}, n == want and merged <= n and (merged > 0) == (n > 0))


@check("S02", "planned actual", "006")
def _(c, cid):
    g = c["stop_place_map"].groupBy("name_norm").agg(F.count(F.lit(1)).alias("n"))
    one, two, more = _one(g, F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.count_if(F.col("n") > 2))
    return _expected(c, cid, {"1": one, "2": two, "3+": more})


@check("S02", "planned actual", "007")
def _(c, cid):
    u, a, limit = c["diag_under_merge"], c["diag_alias"], c.params["places"]["alias_m"]
    bad = _count(u.where("place_id_a >= place_id_b")) + _count(a.where((F.col("place_id_a") >= F.col("place_id_b")) | (F.col("name_a") == F.col("name_b")) | (F.col("gap_m") > limit)))
    pairs = c["places"].groupBy("name_norm").agg(F.count(F.lit(1)).alias("k")).agg(F.coalesce(F.sum(F.expr("k * (k - 1) div 2")), F.lit(0))).first()[0]
    whole = c.params["places"]["under_merge_m"] is not None or _count(u) == pairs
    return record(cid, "CONTRACT", {"bad": bad, "pairs": _count(u)}, {"bad": 0, "pairs": pairs}, bad == 0 and whole)


@check("S02", "planned actual", "008")
def _(c, cid):
    """Geometry computed again from the stops, to half a metre."""
    m = c["stop_place_map"].join(c["stops"].select("stop_id", "lat", "lon"), "stop_id").join(c["places"].select("place_id", "place_name"), "place_id")
    again, _ = places.geometry(m)
    j = c["places"].alias("a").join(again.alias("b"), "place_id")
    moved = geo.haversine(F.col("a.lat_centroid"), F.col("a.lon_centroid"), F.col("b.lat_centroid"), F.col("b.lon_centroid"))
    off = j.where((moved > 0.5) | (F.abs(F.col("a.span_m") - F.col("b.span_m")) > 0.5) | (F.col("a.n_stops") != F.col("b.n_stops")))
    return _zero(cid, _count(off))


@check("S02", "planned actual", "001", "PHYSICAL")
def _(c, cid):
    limit = c.params["places"].get("span_warn_m")
    return None if limit is None else _zero(cid, _count(c["places"].where(F.col("span_m") > limit)), "PHYSICAL")


for _number, _key in (("001", "planned.place.total"), ("002", "planned.place.diag.under_merge_candidates"), ("003", "planned.place.diag.alias_candidates")):

    @check("S02", "planned", _number, "DIFF")
    def _(c, cid, key=_key):
        return _judge(c, cid, _count(c[{"total": "places", "under_merge_candidates": "diag_under_merge", "alias_candidates": "diag_alias"}[key.rsplit(".", 1)[1]]]), key)


# ---- S03 hubs


@check("S03", "planned", "001")
def _(c, cid):
    m = c["place_metrics"]
    lost = _count(primitives.dangling_values(c["places"], "place_id", m, "place_id")) + primitives.repeated_rows(m, ["place_id"]).first()[0]
    return _zero(cid, lost + _count(m.where("D is null or A is null or L is null")))


@check("S03", "planned", "002")
def _(c, cid):
    gate = c.params["hubs"]["gate_degree"]
    return _zero(cid, _count(c["place_metrics"].where(F.col("L_star") != F.when(F.col("D") >= gate, F.col("L")).otherwise(0))))


@check("S03", "planned", "003")
def _(c, cid):
    again = network.qualify(c["place_metrics"], c.params["hubs"]["thresholds"]).select("place_id", F.col("hub_class").alias("again"))
    q = c["hub_qualification"].join(again, "place_id")
    return _zero(cid, _count(q.where("hub_class_rule <> again")))


@check("S03", "planned", "004")
def _(c, cid):
    return _zero(cid, _count(c["place_metrics"].where("A > D")))


@check("S03", "planned", "005")
def _(c, cid):
    e = c["l_space_place_edges"]
    lost = _count(primitives.dangling_values(network.both_ways(e), "p", c["places"], "place_id"))
    bad = _count(e.where("place_a >= place_b or n_routes > n_patterns or n_routes <> size(split(routes, '[|]'))"))
    inside = network.universe_routes(c["route_catalog"], c.params["hubs"]["universe_classes"])
    out = _count(primitives.dangling_values(e.select(F.explode(F.split("routes", r"\|")).alias("r")), "r", inside, "route"))
    return _zero(cid, lost + bad + out + primitives.repeated_rows(e, ["place_a", "place_b"]).first()[0])


@check("S03", "planned", "006")
def _(c, cid):
    k = c.params["hubs"]["k_max"]
    return _zero(cid, _count(c["place_metrics"].where((F.col("L") < 0) | (F.col("L") > k) | ((F.col("D") == 0) & ((F.col("A") != 0) | (F.col("L") != 0))) | ((F.col("D") > 0) != F.col("in_lspace")) | ((F.col("D") > 0) & (F.col("A") < 1)))))


@check("S03", "planned", "007")
def _(c, cid):
    """The grid is whole, one variant is adopted, and it has the counts of the qualification."""
    s, g, h = c["sensitivity"], c.params["hubs"]["grid"], c.params["hubs"]
    want = len(g["mask"]) * len(g["dominance"]) * len(g["k_max"]) + sum(float(a) != float(h["arm_degrees"]) for a in g["arm_degrees"])
    adopted = s.where("is_adopted").collect()
    n = {r["hub_class_rule"]: r["count"] for r in c["hub_qualification"].groupBy("hub_class_rule").count().collect()}
    ok = _count(s) == want and len(adopted) == 1 and adopted[0]["n_crossing"] == n.get("CROSSING", 0) and adopted[0]["n_terminal"] == n.get("TERMINAL", 0)
    return record(cid, "CONTRACT", {"rows": _count(s), "adopted": len(adopted)}, {"rows": want, "adopted": 1}, ok)


@check("S03", "planned", "008")
def _(c, cid):
    q = c["hub_qualification"]
    bad = _count(q.where("is_override <> (override_row is not null) or (not is_override and hub_class <> hub_class_rule)"))
    n = _count(q.where("is_override"))
    want = c.meta.get("n_overrides", n)
    return record(cid, "CONTRACT", {"bad": bad, "applied": n}, {"bad": 0, "applied": want}, bad == 0 and n == want)


@check("S03", "planned", "009")
def _(c, cid):
    return _adds_up(cid, {r["hub_class"]: r["count"] for r in c["hub_qualification"].groupBy("hub_class").count().collect()}, _count(c["places"]))


@check("S03", "planned", "010")
def _(c, cid):
    return _adds_up(cid, {r["reason"]: r["count"] for r in c["diag_lspace_gap"].groupBy("reason").count().collect()}, _count(c["place_metrics"].where("D = 0")))


@check("S03", "planned", "001", "PHYSICAL")
def _(c, cid):
    return _zero(cid, _count(c["l_space_place_edges"].where(F.col("gap_m") > c.params["hubs"]["edge_gap_m"])), "PHYSICAL")


for _number, _key, _where in (
    ("001", "planned.hub.qualified", "hub_class_rule <> 'NONE'"), ("002", "planned.hub.decomposition.crossing", "hub_class_rule = 'CROSSING'"), ("003", "planned.hub.decomposition.terminal", "hub_class_rule = 'TERMINAL'"),
    ("004", "planned.hub.decomposition.peripheral_d_le_2", "D <= 2"), ("005", "planned.hub.decomposition.d_eq_2", "D = 2"),
):

    @check("S03", "planned", _number, "DIFF")
    def _(c, cid, key=_key, where=_where):
        return _judge(c, cid, _count(c["place_metrics"].join(c["hub_qualification"].select("place_id", "hub_class_rule"), "place_id").where(where)), key)


@check("S03", "planned", "006", "DIFF")
def _(c, cid):
    """Named places have the metrics of the baseline: the nearest candidate of the name is compared."""
    spots = c.baseline.get("planned", {}).get("hub", {}).get("spot")
    if not spots:
        return None
    seen = {}
    for name, want in sorted(spots.items()):
        far = F.abs(F.col("D") - want["D"]) + F.abs(F.col("A") - want["A"]) + F.abs(F.col("L") - want["L"])
        row = c["place_metrics"].where(F.col("name_norm") == name).agg(F.min(F.struct(far.alias("far"), "D", "A", "L")).alias("b")).first()["b"]
        seen[name] = None if row is None else {k: row[k] for k in "DAL"}
    want = {k: dict(v) for k, v in spots.items()}
    explained = any(d.check == cid and d.measured == seen for d in c.deviations)
    return Result(cid, "DIFF", "MATCH" if seen == want else "EXPLAINED" if explained else "UNEXPLAINED", seen, want)
