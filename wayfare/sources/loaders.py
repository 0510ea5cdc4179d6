"""Raw tables and their contracts.

Loaders read every column as text, prove the rules that later stages rely on
(one aggregation per table, and a few key checks), and only then return the
table.  Row counts and cardinalities of a delivery are parameters
(``expect``), not code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare import config
from wayfare.checks import primitives
from wayfare.errors import ContractViolation
from wayfare.functions import geo, names, times

BOM = "﻿"
#: Columns of the raw tables, in order.
COLUMNS = {
    "schedule_planned": ["route_name", "stop_name", "stop_sequence", "arrival_time", "departure_time", "route_id", "trip_id", "stop_id"],
    "routes_planned": ["노선명", "정류장순서", "원본순서", "정류장명", "위도", "경도", "행정동", "도착시간들", "출발시간들", "도착횟수"],
    "stops_planned": ["stop_id", "stop_name", "stop_lat", "stop_lon"],
    "events_actual": ["운행 일자", "OBE_ID", "route_id", "route_name", "버스정류장 순번", "stop_id_raw", "stop_name", "stop_id", "arrival_time", "departure_time", "위도", "경도", "권역", "행정동"],
    "routes_actual": ["route_id", "route_name", "stop_sequence", "stop_name", "stop_lat", "stop_lon", "권역", "행정동", "도착시간들", "stop_id", "도착횟수"],
    "stops_actual": ["stop_id", "stop_name", "stop_lat", "stop_lon", "zone", "admin_dong"],
    "tags": ["route", "route_type", "route_id", "dir_label", "n_stops", "frequency", "is_loop", "first", "last", "role", "direction_group", "base_route_id", "confidence", "source", "verified", "verifier_agree", "added_or_removed", "evidence"],
}
#: Id patterns and enumerations of the raw tables.
ROUTE_ID = r"BR_(TAGO_USB\d{9}|ACC0_\d{8})"
STOP_ID = r"BS_(TAGO_USB\d{9}|ACC0_\d{8})"
ENUMS = {
    "role": ["main", "circular", "short_turn", "branch", "detour", "extension", "duplicate", "anomaly"],
    "route_type": ["General", "Express"],
    "confidence": ["high", "medium", "low"],
    "source": ["agent", "auto"],
    "is_loop": ["True", "False"],
    "verified": ["True", "False"],
}
EVIDENCE = T.StructType([T.StructField("route", T.StringType()), T.StructField("n_variants", T.LongType()), T.StructField("variants", T.ArrayType(T.StructType([T.StructField("route_id", T.StringType()), T.StructField("stop_ids", T.ArrayType(T.StringType()))])))])


def scan(spark: SparkSession, folders: Sequence[str], name: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table by logical name, from the first folder that has it."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            reader = spark.read if schema is None else spark.read.schema(schema)
            return reader.parquet(f"{folder}/{name}.parquet")
    raise FileNotFoundError(f"{name}.parquet in none of {list(folders)}")


def _fail(what: str, problem: str) -> None:
    raise ContractViolation(f"{what}: {problem}")


def _columns(df: DataFrame, what: str, columns: Sequence[str] | None = None) -> None:
    want = list(columns or COLUMNS[what])
    if df.columns and df.columns[0].startswith(BOM):
        _fail(what, "the first column name begins with a byte order mark")
    if df.columns != want:
        _fail(what, f"columns are {df.columns}, not {want}")


def _prove(df: DataFrame, what: str, expect: dict | None = None, **violations: Column) -> dict:
    """All counts of violating rows must be 0 and all expected gauges equal, in one job."""
    gauges = {k: v for k, v in (expect or {}).items()}
    counts = {k: F.count_if(F.coalesce(v, F.lit(True))) for k, v in violations.items()}
    seen = primitives.gauges(df, rows=F.count(F.lit(1)), **counts)
    bad = {k: seen[k] for k in violations if seen[k]}
    if bad:
        _fail(what, f"rows that break a rule: {bad}")
    if "rows" in gauges and seen["rows"] != gauges["rows"]:
        _fail(what, f"{seen['rows']} rows, not {gauges['rows']}")
    return seen


def _unique(df: DataFrame, what: str, keys: Sequence[str]) -> None:
    if primitives.repeated_rows(df, keys).first()[0]:
        _fail(what, f"repeated keys {list(keys)}")


def _depends(df: DataFrame, what: str, a: str, b: str) -> None:
    if primitives.dependency_violations(df, a, b).first()[0]:
        _fail(what, f"{b} does not depend on {a}")


def _bad_coordinates(lat: str, lon: str, box: dict | None) -> Column:
    return ~geo.in_box(F.col(lat).try_cast("double"), F.col(lon).try_cast("double"), box or config.load()["coordinates"])


def load_stops_planned(df: DataFrame, expect: dict | None = None, box: dict | None = None) -> DataFrame:
    _columns(df, "stops_planned")
    _prove(df, "stops_planned", expect, coordinates=_bad_coordinates("stop_lat", "stop_lon", box))
    _unique(df, "stops_planned", ["stop_id"])
    return df


def load_stops_actual(df: DataFrame, expect: dict | None = None, box: dict | None = None) -> DataFrame:
    """Ids come as decimal numbers (``N.0``): the suffix goes once every id is proved to have it."""
    _columns(df, "stops_actual")
    _prove(df, "stops_actual", expect, ids=~F.col("stop_id").rlike(r"^\d+\.0$"), coordinates=_bad_coordinates("stop_lat", "stop_lon", box))
    out = df.withColumn("stop_id", names.plain_id(F.col("stop_id")))
    _unique(out, "stops_actual", ["stop_id"])
    return out


def null_block(df: DataFrame, row: Column, columns: Sequence[str] | None = None) -> dict:
    """Number of all-null and partly null rows, and whether the all-null rows are one block in file order."""
    columns = list(columns or df.columns)
    some = F.greatest(*[F.col(c).isNull().cast("int") for c in columns])
    every = F.least(*[F.col(c).isNull().cast("int") for c in columns])
    marked = df.select(some.alias("some"), every.alias("every"), row.alias("row"))
    g = marked.agg(F.sum("every").alias("n"), F.sum(F.col("some") - F.col("every")).alias("partial"), F.min(F.when(F.col("every") == 1, F.col("row"))).alias("a"), F.max(F.when(F.col("every") == 1, F.col("row"))).alias("b")).first()
    n = g["n"] or 0
    return {"all_null": n, "partial_null": g["partial"] or 0, "contiguous": not n or g["b"] - g["a"] + 1 == n}


def load_schedule_planned(df: DataFrame, expect: dict | None = None, row: Column | None = None) -> DataFrame:
    """The timetable without its one block of empty rows (``row``: position in the file, where it is known)."""
    what = "schedule_planned"
    _columns(df, what)
    found = null_block(df, row if row is not None else F.monotonically_increasing_id())
    if found["partial_null"]:
        _fail(what, f"{found['partial_null']} partly empty rows")
    if row is not None and not found["contiguous"]:
        _fail(what, "the empty rows are not one block")
    if expect and "all_null" in expect and found["all_null"] != expect["all_null"]:
        _fail(what, f"{found['all_null']} empty rows, not {expect['all_null']}")
    out = df.na.drop("all")
    clock = r"^\d{1,2}:[0-5]\d:[0-5]\d$"
    _prove(
        out, what, expect,
        route_id=~F.col("route_id").rlike(f"^{ROUTE_ID}$"),
        stop_id=~F.col("stop_id").rlike(f"^{STOP_ID}$"),
        trip_id=~F.col("trip_id").rlike(f"^{ROUTE_ID}_Ord\\d{{3}}$") | (F.regexp_replace("trip_id", r"_Ord\d{3}$", "") != F.col("route_id")),
        times=~F.col("arrival_time").rlike(clock) | ~F.col("departure_time").rlike(clock),
    )
    _unique(out, what, ["trip_id", "stop_sequence"])
    _depends(out, what, "route_id", "route_name")
    _depends(out, what, "stop_id", "stop_name")
    return out


def _runs_from_one(df: DataFrame, what: str, key: str, position: str) -> None:
    p = F.col(position).try_cast("int")
    g = df.groupBy(key).agg(F.min(p).alias("a"), F.max(p).alias("b"), F.count(F.lit(1)).alias("n"))
    if g.where("a is null or a <> 1 or b <> n").limit(1).count():
        _fail(what, f"{position} is not 1..N for some {key}")


def load_routes_planned(df: DataFrame, expect: dict | None = None) -> DataFrame:
    what = "routes_planned"
    _columns(df, what)
    nulls = F.greatest(*[F.col(c).isNull() for c in df.columns if c != "행정동"])
    n = F.col("도착횟수").try_cast("int")
    _prove(df, what, expect, nulls=nulls, tokens=(times.token_count(F.col("도착시간들")) != n) | (times.token_count(F.col("출발시간들")) != n))
    _unique(df, what, ["노선명", "정류장순서"])
    _runs_from_one(df, what, "노선명", "정류장순서")
    return df


def load_events_actual(df: DataFrame, expect: dict | None = None) -> DataFrame:
    """The arrival log of one service date; departures are clock texts or the two texts that stand for none."""
    what = "events_actual"
    _columns(df, what)
    fits = lambda c: F.regexp_replace(F.col(c), " ", " ").rlike(r"^\d{4}-\d{2}-\d{2} (오전|오후) \d{1,2}:\d{2}:\d{2}$")
    _prove(df, what, expect, arrival=~fits("arrival_time"), departure=~(fits("departure_time") | times.is_no_departure(F.col("departure_time"))))
    if df.select("운행 일자").distinct().limit(2).count() > 1:
        _fail(what, "more than one service date")
    grid = df.groupBy("route_id", "버스정류장 순번").agg(F.countDistinct("stop_id").alias("k"))
    if grid.where("k > 1").limit(1).count():
        _fail(what, "a stop number of a pattern has several stops")
    _unique(df, what, ["OBE_ID", "route_id", "버스정류장 순번", "arrival_time"])
    return df


def load_routes_actual(df: DataFrame, expect: dict | None = None, box: dict | None = None) -> DataFrame:
    """The per-stop aggregate of the log: rows with one arrival spell the time out, all others use HH:MM:SS."""
    what = "routes_actual"
    _columns(df, what)
    single, tokens = F.col("도착횟수") == "1", F.split("도착시간들", r"\|")
    spelled = F.forall(tokens, lambda x: x.rlike(r"^\d{1,2}시 \d{1,2}분 \d{1,2}초$"))
    plain = F.forall(tokens, lambda x: x.rlike(r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"))
    _prove(
        df, what, expect,
        nulls=F.greatest(*[F.col(c).isNull() for c in df.columns]),
        tokens=F.size(tokens) != F.col("도착횟수").try_cast("int"),
        formats=F.when(single, ~spelled).otherwise(~plain),
        coordinates=_bad_coordinates("stop_lat", "stop_lon", box),
    )
    _unique(df, what, ["route_id", "stop_sequence"])
    _runs_from_one(df, what, "route_id", "stop_sequence")
    _depends(df, what, "route_id", "route_name")
    return df


def read_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A CSV with this header, all text; a byte order mark before the header is dropped, quoted fields may hold line breaks."""
    df = spark.read.option("header", True).option("inferSchema", False).option("multiLine", True).option("escape", '"').csv(path)
    df = df.toDF(*[c.removeprefix(BOM) for c in df.columns])
    _columns(df, path, columns)
    return df


def load_tags(df: DataFrame, expect: dict | None = None) -> DataFrame:
    """Role tags: enumerations, key, references inside the file, source=agent exactly where verified."""
    what = "tags"
    _columns(df, what)
    outside = {f"enum_{c}": ~F.col(c).isin(v) for c, v in ENUMS.items()}
    numbers = F.col("n_stops").try_cast("int").isNull() | F.col("frequency").try_cast("int").isNull()
    _prove(df, what, expect, **outside, numbers=numbers, ids=~F.col("route_id").rlike(f"^{ROUTE_ID}$"), verified=(F.col("source") == "agent") != (F.col("verified") == "True"))
    _unique(df, what, ["route_id"])
    if primitives.dangling_values(df, "base_route_id", df, "route_id").limit(1).count():
        _fail(what, "a base reference is not in the file")
    return df


def typed_tags(df: DataFrame) -> DataFrame:
    """Tags with engine names and types; base references stay as they were tagged."""
    flag = lambda c: (F.col(c) == "True").alias(c)
    return df.select(F.col("route_id").alias("pattern_id"), "route", "role", F.col("base_route_id").alias("base_id"), "direction_group", F.col("n_stops").cast("int").alias("n_stops"), F.col("frequency").cast("int").alias("frequency"), flag("is_loop"), flag("verified"))


def load_evidence(spark: SparkSession, folder: str, expect: dict | None = None) -> DataFrame:
    """Evidence documents, one per route: (route, n_variants, variants); the file name is the route."""
    df = spark.read.schema(EVIDENCE).option("multiLine", True).json(folder, pathGlobFilter="*.json").select("*", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("__file"))
    stem = F.try_url_decode(F.col("__file"))
    _prove(df, "evidence", expect, names=F.col("route").isNull() | (F.coalesce(stem, F.col("__file")) != F.col("route")), keys=F.col("n_variants").isNull() | F.col("variants").isNull())
    return df.drop("__file")


def evidence_sequences(evidence: DataFrame) -> DataFrame:
    v = evidence.select(F.explode("variants").alias("v"))
    return v.select(F.col("v.route_id").alias("pattern_id"), F.col("v.stop_ids").alias("stop_ids"))


def aliases(df: DataFrame) -> dict[str, str]:
    """An alias table (alias, name) as a dictionary; it is a short hand-kept list."""
    rows = df.limit(10_001).collect()
    if len(rows) > 10_000:
        raise ContractViolation("more than 10,000 aliases")
    return {r[0]: r[1] for r in rows}
