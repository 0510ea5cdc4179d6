"""The control plane: gates with dummy stages, and the transit pipeline end to end on a small world."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from wayfare import config
from wayfare.checks import contracts, judge, lint, primitives
from wayfare.control import cli
from wayfare.control.runner import CONTRACT, HELD, OK, UNEXPLAINED, UPSTREAM, Runner, Stage
from wayfare.errors import ContractViolation, UpstreamMissing, WriteViolation
from wayfare.sources import loaders, sinks


def result(cls="CONTRACT", status="PASS", cid="C-1"):
    return primitives.Result(cid, cls, status, 1, 1)


def dummy(spark, tmp_path, results=(), value=1, **more):
    state = {"results": list(results), "value": value, "builds": 0}

    def build(job):
        state["builds"] += 1
        return {"t": job.spark.range(3).withColumn("x", F.lit(state["value"]))}

    def after(job):
        return {"u": job.table("first", "t")}

    checks = lambda job, path: list(state["results"])
    registry = {"second": Stage({"planned": after}, ("first",), lambda job, path: [result()]), "first": Stage({"planned": build}, (), checks, **more)}
    return Runner(spark, tmp_path, registry), state


def test_publish_reuse_and_stale(spark, tmp_path):
    r, state = dummy(spark, tmp_path, [result()])
    assert r.order() == ["first", "second"]
    assert r.run_all("planned") == OK and r.run_all("planned") == OK and state["builds"] == 1
    assert [x["state"] for x in r.status()] == ["FRESH", "FRESH"]
    r.params = {**r.params, "checks": {"tolerance": 1}}
    state["value"] = 2
    assert r.status()[0]["why"] == ["parameters changed"]
    assert r.run("first", "planned") == OK and r.store.latest("first", "planned") == "v002"
    assert r.status()[1]["state"] == "STALE"
    r.params = config.load()
    assert r.run("first", "planned") == OK and r.store.latest("first", "planned") == "v001"
    assert r.run("second", "planned", pins={"first": "v002"}) == OK
    assert len((tmp_path / "runs.jsonl").read_text().splitlines()) == 7


def test_gates(spark, tmp_path):
    r, state = dummy(spark, tmp_path, [result(status="FAIL")])
    assert r.run("second", "planned") == UPSTREAM and r.run("nothing", "planned") == UPSTREAM and r.run("first", "actual") == UPSTREAM
    assert r.run("first", "planned") == CONTRACT
    assert [p.name for p in r.store.versions("first", "planned")] == ["v001-rejected"]
    state["results"] = [result("PHYSICAL", "FAIL", "P-1")]
    assert r.run("first", "planned") == HELD
    with pytest.raises(UpstreamMissing):
        r.store.latest("first", "planned")
    assert r.publish_pending("first", "planned", "v002", ("P-1",)) == HELD
    assert r.publish_pending("first", "planned", "v002", (), "me") == HELD
    assert r.publish_pending("first", "planned", "v002", ("P-1",), "me") == OK
    assert r.store.manifest(r.store.version("first", "planned"))["reviewed_by"] == "me"
    state["results"], r.params = [result("DIFF", "UNEXPLAINED", "D-1")], {**r.params, "x": 1}
    assert r.run("first", "planned") == UNEXPLAINED
    assert r.run("second", "planned") == OK and r.status()[1]["unexplained"] == ["D-1"]


def test_changed_output_is_found(spark, tmp_path):
    r, _ = dummy(spark, tmp_path, [result()])
    r.run("first", "planned")
    path = r.store.version("first", "planned")
    assert r.recheck("planned")["first"]["changed"] == []
    (path / "t" / "extra.txt").write_text("x")
    assert r.recheck("planned")["first"]["changed"] == ["t"]
    assert r.run("second", "planned") == UPSTREAM


def test_review_gate_uses_the_build(spark, tmp_path):
    r, _ = dummy(spark, tmp_path, [result()], reviewed=("config/o.{scope}.csv",))
    (tmp_path / "config").mkdir()
    (tmp_path / "config/o.planned.csv").write_text("a,b\n1,2\n")
    assert r.run("first", "planned") == HELD
    (tmp_path / "config/o.planned.csv").write_text("a,b\n")
    assert r.store.manifest(r.store.version("first", "planned", "v001"))["needs_review"]
    assert r.publish_pending("first", "planned", "v001", (), "me") == OK


def test_write_policy(spark, tmp_path):
    r, _ = dummy(spark, tmp_path)
    with pytest.raises(WriteViolation):
        r.store.assert_writable(tmp_path / "x")
    with r.store.building(tmp_path / "v"):
        r.store.assert_writable(tmp_path / "v" / "x")
        with pytest.raises(WriteViolation):
            r.store.assert_writable(tmp_path / "w")


def test_cycles_and_errors_in_builders(spark, tmp_path):
    with pytest.raises(ValueError, match="cycle"):
        Runner(spark, tmp_path, {"a": Stage({"planned": lambda j: {}}, ("b",)), "b": Stage({"planned": lambda j: {}}, ("a",))}).order()

    def broken(job):
        raise ContractViolation("no")

    assert Runner(spark, tmp_path, {"a": Stage({"planned": broken}, (), lambda j, p: [])}).run("a", "planned") == CONTRACT


def test_primitives(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", None)], "k int, s string, v double")
    p = primitives
    counts = {r["id"]: r["n"] for r in p.Audit(df).row(like=p.not_like("s", "[a]"), within=p.not_within("v", 1, 2), open_end=p.not_within("v", 1, 2, open_end=True), among=p.not_among("s", ["a"])).table(
        repeated=p.repeated_rows(df, ["k"]), unique=p.repeated_rows(df, ["k", "s"]), depends=p.dependency_violations(df, "k", "s"), same=p.dependency_violations(df, "k", "k"),
        order=p.order_violations(df, ["s"], ["k"], "v"), dangling=p.dangling_values(df, "k", df.where("k = 1"), "k"),
    ).counts().collect()}
    assert counts == {"like": 1, "within": 0, "open_end": 1, "among": 1, "repeated": 1, "unique": 0, "depends": 1, "same": 0, "order": 0, "dangling": 1}
    lost = p.clean("x", "CONTRACT", p.dangling_values(df, "k", df.where("k = 1"), "k"))
    assert lost.failed and lost.observed == {"violations": 1, "some": ["2"]} and not p.clean("x", "CONTRACT", p.repeated_rows(df, ["k", "s"])).failed
    assert p.values(df, "s", p.not_among("s", ["a"])).collect()[0]["value"] == "b"
    assert p.record("x", "PHYSICAL", 4, 4).status == "PASS" and p.record("x", "PHYSICAL", 4, 5, note="why").to_dict()["note"] == "why" and p.record("x", "PHYSICAL", 4, 4).severity == "WARN"
    with pytest.raises(ValueError):
        p.record("x", "OTHER", 1, 1)
    s = p.summarize([result(), result("PHYSICAL", "FAIL", "P"), result("CONTRACT", "FAIL", "C"), result("DIFF", "UNEXPLAINED", "D")])
    assert (s["blocking"], s["warnings"], s["unexplained"]) == (["C"], ["P"], ["D"])


def test_judge(tmp_path):
    base, known = {"a": {"b": 5}}, [judge.Deviation("K", "D-1", 5, 7)]
    assert judge.judge("D-1", 5, "a.b", base).status == "MATCH" and judge.judge("D-1", 6, "a.b", base, tolerance=1).status == "MATCH"
    assert judge.judge("D-1", 7, "a.b", base, known).status == "EXPLAINED"
    again = [judge.judge("D-1", 8, "a.b", base, known, notes=tmp_path, metric="Some metric") for _ in range(2)]
    assert {r.status for r in again} == {"UNEXPLAINED"} and len(list(tmp_path.iterdir())) == 1 and len(next(tmp_path.iterdir()).read_text().splitlines()) == 1
    with pytest.raises(KeyError):
        judge.lookup(base, "a.c")
    assert lint.check_names("x", ["fine", "Excessive_wait"]).failed and not lint.check_names("x", ["fine"]).failed


# ---- a small world


def clock(s):
    return f"{s // 3600}:{s % 3600 // 60:02d}:{s % 60:02d}"


def write_csv(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def rid(n):
    return f"BR_TAGO_USB{n:09d}"


def sid(n):
    return f"BS_TAGO_USB{n:09d}"


AT = {n: (35.30 + (n % 7) * 0.004, 129.10 + (n // 7) * 0.004) for n in range(30)}
PATTERNS = {1: ("1", [0, 1, 2, 3, 4, 11], "main", 1), 2: ("1", [0, 1, 2], "short_turn", 1), 3: ("2", [7, 8, 2, 10, 11], "circular", None), 4: ("2", [7, 8, 9], "detour", 3), 5: ("3", [2, 16, 23, 9], "main", None), 6: ("5001", [14, 2, 28], "main", None), 7: ("1지원1", [0, 1, 2, 3], None, None)}


@pytest.fixture
def world(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    string = lambda names: ", ".join(f"`{c}` string" for c in names)
    times, listed = [], {}
    for p, (route, stops, *_) in PATTERNS.items():
        for trip in range(2):
            for i, s in enumerate(stops, 1):
                t = 6 * 3600 + trip * 3600 + i * 120
                times.append((route, f"N{s}", str(i), clock(t), clock(t if i == 1 else t + 10), rid(p), f"{rid(p)}_Ord{trip + 1:03d}", sid(s)))
                listed.setdefault((route, s), []).append(t)
    times[5:5] = [(None,) * 8] * 2
    spark.createDataFrame(times, string(loaders.COLUMNS["schedule_planned"])).coalesce(1).write.parquet(str(raw / "schedule_planned.parquet"))
    spark.createDataFrame([(sid(n), f"N{n}", str(y), str(x)) for n, (y, x) in AT.items()], string(loaders.COLUMNS["stops_planned"])).write.parquet(str(raw / "stops_planned.parquet"))
    number, rows = {}, []
    for (route, s), ts in listed.items():
        number[route] = number.get(route, 0) + 1
        text = "|".join(f"{t // 3600}시 {t % 3600 // 60}분 {t % 60}초" for t in ts)
        rows.append((route, str(number[route]), str(number[route]), f"N{s}", str(AT[s][0]), str(AT[s][1]), None, text, text, str(len(ts))))
    spark.createDataFrame(rows, string(loaders.COLUMNS["routes_planned"])).write.parquet(str(raw / "routes_planned.parquet"))
    tags = [(r, "General", rid(p), "d", str(len(s)), "2", "False", "a", "b", role, "0", rid(base) if base else "", "high", "agent", "True", "", "", "") for p, (r, s, role, base) in PATTERNS.items() if role]
    write_csv(raw / "tags.csv", loaders.COLUMNS["tags"], tags)
    (raw / "evidence").mkdir()
    for route in {r for r, *_ in PATTERNS.values()}:
        doc = {"route": route, "n_variants": 1, "variants": [{"route_id": rid(p), "stop_ids": [sid(x) for x in s]} for p, (r, s, *_) in PATTERNS.items() if r == route]}
        (raw / "evidence" / f"{route}.json").write_text(json.dumps(doc, ensure_ascii=False), encoding="utf-8")
    events, agg = [], {}
    for v in range(3):
        for trip in range(3):
            for i, s in enumerate([0, 1, 2, 3], 1):
                if trip == 1 and i == 1:
                    continue
                t = 6 * 3600 + v * 60 + trip * 7200 + i * 120
                text = f"2025-05-06 {'오전' if t < 43200 else '오후'} {(t // 3600 - 1) % 12 + 1}:{t % 3600 // 60:02d}:{t % 60:02d}"
                events.append(("20250506", f"O{v}", "1930010", "701", str(i), "9", f"N{s}", str(s), text, "0001-01-01" if trip == 2 else text, "35.3", "129.1", "z", "d"))
                agg.setdefault((i, s), []).append(clock(t).zfill(8))
    spark.createDataFrame(events, string(loaders.COLUMNS["events_actual"])).write.parquet(str(raw / "events_actual.parquet"))
    spark.createDataFrame([(f"{n}.0", f"N{n}", str(y), str(x), "z", "d") for n, (y, x) in AT.items()], string(loaders.COLUMNS["stops_actual"])).write.parquet(str(raw / "stops_actual.parquet"))
    spark.createDataFrame([("1930010", "701", str(i), f"N{s}", str(AT[s][0]), str(AT[s][1]), "z", "d", "|".join(ts), str(s), str(len(ts))) for (i, s), ts in agg.items()], string(loaders.COLUMNS["routes_actual"])).write.parquet(str(raw / "routes_actual.parquet"))
    rules = {"planned": "[{class: express, rule: 'fullmatch:\\d{4}', expect: 1}, {class: support, rule: 'contains:지원', expect: 1}, {class: general, rule: fallback, expect: 3}]", "actual": "[{class: town, rule: 'fullmatch:x', expect: 0}, {class: general, rule: fallback, expect: 1}]"}
    (tmp_path / "config").mkdir()
    for era, text in rules.items():
        (tmp_path / "config" / f"rules_{era}.yaml").write_text(f"era: {era}\nrules: {text}\n", encoding="utf-8")
    return tmp_path


def failures(runner, stage, scope):
    folder = max(p for p in runner.store.folder(stage, scope).iterdir() if p.is_dir())
    return [c for c in json.loads((folder / "checks.json").read_text()) if c["status"] == "FAIL"]


def test_transit_pipeline(spark, world):
    r = Runner(spark, world)
    code = r.run_all("planned")
    assert code == OK, {s: failures(r, s, "planned") for s in r.order() if r.store.versions(s, "planned")}
    read = lambda s, t: spark.read.parquet(str(r.store.version(s, "planned") / t))
    assert read("ingest", "stop_times").count() == sum(2 * len(s) for _, s, *_ in PATTERNS.values())
    got = {x["pattern_id"]: (x["role"], x["in_backbone"]) for x in read("canonical", "patterns").collect()}
    assert got[rid(7)] == ("support", False) and got[rid(3)] == ("circular", True) and got[rid(4)] == ("detour", False)
    assert {x["route"] for x in read("canonical", "trip_attribution").where("attribution = 'support'").collect()} == {"1"}
    metrics = {x["name_norm"]: x["D"] for x in read("hubs", "place_metrics").collect()}
    assert metrics["N2"] == 5 and metrics["N5"] == 0
    assert read("hubs", "diag_lspace_gap").where("name_norm = 'N28'").first()["reason"] == "out_of_universe_only"
    assert (r.store.version("hubs", "planned") / "semantics.yaml").exists()
    rechecked = r.recheck("planned")
    assert not any(x["changed"] or x["checks"]["blocking"] for x in rechecked.values())
    assert cli.main(["--workspace", str(world), "status"], spark) == 0
    # a changed number in a published table is found by the checks of its stage
    m = read("hubs", "place_metrics").withColumn("A", F.col("A") + 50)
    folders = [r.store.version(s, "planned") for s in ("canonical", "places", "hubs")]
    tables = {p.name: spark.read.parquet(str(p)) for f in folders for p in f.iterdir() if p.is_dir()} | {"place_metrics": m}
    bad = {x.check_id for x in contracts.run("S03", contracts.Context(tables, r.params)) if x.failed}
    assert {"C-S03-B-003", "C-S03-B-004"} & bad and "C-S03-B-002" not in bad
    e = tables["l_space_place_edges"].union(tables["l_space_place_edges"].limit(1))
    assert any(x.failed and x.check_id == "C-S03-B-005" for x in contracts.run("S03", contracts.Context(tables | {"l_space_place_edges": e, "place_metrics": read("hubs", "place_metrics")}, r.params)))


def test_positive_controls_fail_without_their_anomaly(spark, world):
    r = Runner(spark, world, expect={"C-S00-B-008": 3})
    assert r.run("ingest", "planned") == CONTRACT
    assert [c["check_id"] for c in failures(r, "ingest", "planned")] == ["C-S00-B-008"]


def test_actual_scope(spark, world):
    r = Runner(spark, world, expect={"C-S01-A-003": {"rate": 1 / 3}, "C-S00-A-004": 12})
    code = r.run_all("actual")
    assert code == OK, {s: failures(r, s, "actual") for s in r.order() if "actual" in r.registry[s].scopes and r.store.versions(s, "actual")}
    trips = spark.read.parquet(str(r.store.version("canonical", "actual") / "trips"))
    assert trips.count() == 9 and trips.where("is_partial").count() == 3
    assert spark.read.parquet(str(r.store.version("canonical", "actual") / "main_proposal")).first()["basis"] == "both"


def test_place_overrides_need_review(spark, world):
    r = Runner(spark, world)
    assert r.run_all("planned") == OK
    ids = {x["name_norm"]: x["place_id"] for x in spark.read.parquet(str(r.store.version("places", "planned") / "places")).collect()}
    write_csv(world / "config/place_overrides.planned.csv", ["action", "place_a", "place_b", "reason", "source"], [("merge", ids["N5"], ids["N6"], "same", "me")])
    assert r.run("places", "planned") == HELD
    assert r.publish_pending("places", "planned", "v002", ("P-S02-B-001",), "me") == OK
    assert spark.read.parquet(str(r.store.version("places", "planned") / "places")).where("is_override_merged").count() == 1
    assert [x["state"] for x in r.status() if x["stage"] == "hubs"] == ["STALE"]


def test_loaders_reject(spark, world):
    raw = world / "raw"
    s = spark.read.parquet(str(raw / "schedule_planned.parquet"))
    loaders.load_schedule_planned(s, {"all_null": 2}, F.col("_metadata.row_index"))
    for bad in (s.withColumn("stop_id", F.lit("x")), s.withColumn("arrival_time", F.when(F.col("stop_sequence") != "1", F.col("arrival_time"))), s.union(s), s.drop("stop_id")):
        with pytest.raises(ContractViolation):
            loaders.load_schedule_planned(bad)
    t = spark.read.parquet(str(raw / "stops_actual.parquet"))
    with pytest.raises(ContractViolation):
        loaders.load_stops_actual(t.withColumn("stop_id", F.lit("7")))
    with pytest.raises(ContractViolation):
        loaders.load_stops_actual(t.withColumn("stop_lat", F.lit("0")))
    tags = loaders.read_csv(spark, str(raw / "tags.csv"), loaders.COLUMNS["tags"])
    assert loaders.load_tags(tags, {"rows": 6}).count() == 6
    for bad in (tags.withColumn("role", F.lit("boss")), tags.withColumn("verified", F.lit("False")), tags.withColumn("base_route_id", F.lit("BR_ACC0_00000000"))):
        with pytest.raises(ContractViolation):
            loaders.load_tags(bad)
    e = spark.read.parquet(str(raw / "events_actual.parquet"))
    for bad in (e.union(e), e.withColumn("departure_time", F.lit("later")), e.withColumn("arrival_time", F.lit("2025-05-06 6:00:00"))):
        with pytest.raises(ContractViolation):
            loaders.load_events_actual(bad)
    with pytest.raises(FileNotFoundError):
        loaders.scan(spark, [str(raw)], "nothing")
    with pytest.raises(KeyError):
        config.rules("planned", str(config.HERE / "rules_actual.yaml"))


def test_digest_ignores_order(spark):
    df = spark.range(50).withColumn("x", F.col("id") * 2)
    assert sinks.table_digest(df) == sinks.table_digest(df.orderBy(F.desc("id")).repartition(7)) != sinks.table_digest(df.limit(49))


def test_streaming_trips_match_batch(spark, tmp_path):
    from wayfare.operators import sequences
    from wayfare.plans import fixtures
    from wayfare.streaming import trips

    log = fixtures.log(spark, "/root/testdata/sf0.001").select(F.col("service_date").cast("string").alias("service_date"), "vehicle_id", "pattern_id", "arr_ts", "master_seq")
    log.coalesce(1).write.parquet(str(tmp_path / "in"))
    q = trips.stream(spark.readStream.schema(log.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("numbered").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    batch = sequences.sessions(log, ["service_date", "vehicle_id", "pattern_id"], ["arr_ts", "master_seq"], "master_seq").select(*log.columns, "trip_no")
    assert sorted(map(str, spark.table("numbered").collect())) == sorted(map(str, batch.collect()))
