"""The stages of the transit pipeline and how they read a workspace.

``raw/`` of the workspace has the delivered tables, ``config/`` hand-kept
files: ``aliases.csv``, ``place_overrides.<scope>.csv``, ``hub_overrides.csv``.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from wayfare import config
from wayfare.control.runner import Job, Stage
from wayfare.control.store import sha256_path
from wayfare.errors import ContractViolation
from wayfare.operators import places
from wayfare.plans import stages
from wayfare.sources import loaders, sinks

HUB_COLUMNS = ["place_id", "hub_class", "reason", "source"]


def _aliases(job: Job) -> dict[str, str]:
    return {r["alias"]: r["name"] for r in job.rows("config/aliases.csv")}


def _raw(job: Job, *names: str) -> None:
    job.meta["raw_hashes"] = {n: sha256_path(Path(job.raw(n))) for n in names}


def _expect(job: Job, name: str) -> dict | None:
    return job.expect.get("raw", {}).get(name)


def ingest_planned(job: Job) -> stages.Tables:
    _raw(job, "schedule_planned.parquet", "stops_planned.parquet", "routes_planned.parquet", "tags.csv", "evidence")
    read, box = job.spark.read.parquet, job.params["coordinates"]
    schedule = read(job.raw("schedule_planned.parquet"))
    raw = {
        "schedule": loaders.load_schedule_planned(schedule, _expect(job, "schedule_planned"), F.col("_metadata.row_index")),
        "stops": loaders.load_stops_planned(read(job.raw("stops_planned.parquet")), _expect(job, "stops_planned"), box),
        "routes": loaders.load_routes_planned(read(job.raw("routes_planned.parquet")), _expect(job, "routes_planned")),
        "tags": loaders.typed_tags(loaders.load_tags(loaders.read_csv(job.spark, job.raw("tags.csv"), loaders.COLUMNS["tags"]), _expect(job, "tags"))),
    }
    out = stages.ingest_planned(raw, job.params, _aliases(job))
    out["evidence"] = loaders.evidence_sequences(loaders.load_evidence(job.spark, job.raw("evidence")))
    return out


def ingest_actual(job: Job) -> stages.Tables:
    _raw(job, "events_actual.parquet", "stops_actual.parquet", "routes_actual.parquet")
    read, box = job.spark.read.parquet, job.params["coordinates"]
    raw = {
        "events": loaders.load_events_actual(read(job.raw("events_actual.parquet")), _expect(job, "events_actual")),
        "stops": loaders.load_stops_actual(read(job.raw("stops_actual.parquet")), _expect(job, "stops_actual"), box),
        "routes": loaders.load_routes_actual(read(job.raw("routes_actual.parquet")), _expect(job, "routes_actual"), box),
    }
    return stages.ingest_actual(raw, job.params)


def _rules(job: Job) -> dict:
    own = job.workspace / "config" / f"rules_{job.scope}.yaml"
    return config.rules(job.scope, str(own) if own.exists() else None)


def _prepare_rules(job: Job) -> None:
    job.meta["rules"] = _rules(job)


def canonical_planned(job: Job) -> stages.Tables:
    _prepare_rules(job)
    tables = {n: job.table("ingest", n) for n in ("stop_times", "trips", "stops", "route_union", "variant_tags", "evidence")}
    return stages.canonical_planned(tables, job.params, job.meta["rules"])


def canonical_actual(job: Job) -> stages.Tables:
    _prepare_rules(job)
    tables = {n: job.table("ingest", n) for n in ("events", "route_master")}
    job.meta["route_master_digest"] = sinks.table_digest(tables["route_master"])
    return stages.canonical_actual(tables, job.params, job.meta["rules"])


canonical_planned.prepare = canonical_actual.prepare = _prepare_rules


def _overrides(job: Job, name: str, columns: list[str]) -> list[dict]:
    rows = job.rows(name)
    if rows and list(rows[0]) != columns:
        raise ContractViolation(f"{name} has columns {list(rows[0])}, not {columns}")
    job.meta["n_overrides"] = len(rows)
    return rows


def merge_places(job: Job) -> stages.Tables:
    rows = _overrides(job, f"config/place_overrides.{job.scope}.csv", places.OVERRIDE_COLUMNS)
    return stages.merge_places({"stops": job.table("ingest", "stops")}, job.params, job.scope, rows, _aliases(job))


def hubs(job: Job) -> stages.Tables:
    rows = _overrides(job, "config/hub_overrides.csv", HUB_COLUMNS)
    tables = {n: job.table("canonical", n) for n in ("backbone_stops", "route_catalog", "patterns", "pattern_stops")}
    tables |= {n: job.table("places", n) for n in ("places", "stop_place_map")}
    job.meta["semantics"] = sinks.semantics(job.scope, job.params["hubs"]["universe_classes"])
    table = job.spark.createDataFrame([(i, r["place_id"], r["hub_class"]) for i, r in enumerate(rows, 1)], "row_no int, place_id string, hub_class string")
    return stages.hubs(tables, job.params, table)


REGISTRY = {
    "ingest": Stage(
        {"planned": ingest_planned, "actual": ingest_actual}, (), "S00",
        {"planned": ("raw/schedule_planned.parquet", "raw/stops_planned.parquet", "raw/routes_planned.parquet", "raw/tags.csv", "raw/evidence"), "actual": ("raw/events_actual.parquet", "raw/stops_actual.parquet", "raw/routes_actual.parquet")},
    ),
    "canonical": Stage({"planned": canonical_planned, "actual": canonical_actual}, ("ingest",), "S01"),
    "places": Stage({"planned": merge_places, "actual": merge_places}, ("ingest",), "S02", reviewed=("config/place_overrides.{scope}.csv",)),
    "hubs": Stage({"planned": hubs}, ("canonical", "places"), "S03", reviewed=("config/hub_overrides.csv",)),
}
