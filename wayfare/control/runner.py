"""Running stages: resolve inputs, reuse or build, check, gate, publish."""

from __future__ import annotations

import csv
import importlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from wayfare import config
from wayfare.checks import contracts, primitives
from wayfare.control.store import Store, code_hash, sha256_json, sha256_path
from wayfare.errors import ContractViolation, UpstreamCorrupt, UpstreamMissing
from wayfare.sources import sinks

OK, CONTRACT, HELD, UNEXPLAINED, UPSTREAM = 0, 2, 3, 4, 5


@dataclass
class Stage:
    """How a stage is wired.

    ``builders`` are callables, or dotted ``module:function`` names, by scope:
    ``(job) -> tables``.  ``inputs`` are the only stages it may read.  ``files``
    are raw inputs by scope, relative to the workspace, and ``reviewed`` hand
    kept override files whose rows need a reviewer before publication.
    """

    builders: dict[str, Callable | str]
    inputs: tuple[str, ...] = ()
    checks: str = ""
    files: dict[str, tuple[str, ...]] = field(default_factory=dict)
    reviewed: tuple[str, ...] = ()

    @property
    def scopes(self) -> tuple[str, ...]:
        return tuple(self.builders)


@dataclass
class Job:
    """What a builder is given."""

    spark: SparkSession
    workspace: Path
    scope: str
    params: dict
    upstream: dict[str, Path]
    expect: dict = field(default_factory=dict)
    meta: dict = field(default_factory=dict)

    def table(self, stage: str, name: str) -> DataFrame:
        if stage not in self.upstream:
            raise KeyError(f"{stage} is not a declared input")
        return self.spark.read.parquet(str(self.upstream[stage] / name))

    def raw(self, name: str) -> str:
        return str(self.workspace / "raw" / name)

    def rows(self, name: str) -> list[dict]:
        """Rows of a hand-kept CSV of the workspace; none if it is not there."""
        path = self.workspace / name
        if not path.exists():
            return []
        with open(path, encoding="utf-8-sig", newline="") as f:
            return list(csv.DictReader(f))


def resolve(ref: Callable | str) -> Callable:
    if callable(ref):
        return ref
    module, _, name = ref.partition(":")
    return getattr(importlib.import_module(module), name)


class Runner:
    def __init__(self, spark: SparkSession, workspace: str | Path, registry: dict[str, Stage] | None = None, params: dict | None = None, expect: dict | None = None, baseline: dict | None = None, deviations: list | None = None):
        from wayfare.control.registry import REGISTRY

        self.spark, self.workspace = spark, Path(workspace)
        self.registry = REGISTRY if registry is None else registry
        self.params = params or config.load()
        self.expect, self.baseline, self.deviations = expect or {}, baseline or {}, deviations or []
        self.store = Store(workspace, self.params["control"]["version_digits"])

    def order(self) -> list[str]:
        """Stages, inputs before those that read them; a cycle is an error."""
        out: list[str] = []
        left = dict(self.registry)
        while left:
            ready = [n for n, s in left.items() if all(i in out for i in s.inputs)]
            if not ready:
                raise ValueError(f"stages in a cycle: {sorted(left)}")
            out += ready
            for n in ready:
                del left[n]
        return out

    def _files(self, stage: Stage, scope: str) -> dict[str, str]:
        names = [*stage.files.get(scope, ()), *(f.format(scope=scope) for f in stage.reviewed)]
        return {n: sha256_path(self.workspace / n) for n in names if (self.workspace / n).exists()}

    def inputs(self, name: str, scope: str, pins: dict[str, str] | None = None) -> tuple[dict[str, Path], dict]:
        """Verified upstream folders, and the hashes of all inputs."""
        stage = self.registry[name]
        folders = {i: self.store.upstream(i, scope, (pins or {}).get(i)) for i in stage.inputs}
        missing = [f for f in stage.files.get(scope, ()) if not (self.workspace / f).exists()]
        if missing:
            raise UpstreamMissing(f"raw inputs are missing: {missing}")
        hashes = {f"{i}/{k}": v["sha256"] for i, p in folders.items() for k, v in self.store.manifest(p)["outputs"].items()}
        return folders, {"upstream": {i: p.name for i, p in folders.items()}, "outputs": hashes, "files": self._files(stage, scope)}

    def key(self, inputs: dict) -> str:
        """Identity of a result: inputs by content (version names left out), parameters and code."""
        return sha256_json({"outputs": inputs["outputs"], "files": inputs["files"], "params": self.params, "code": code_hash()})

    def needs_review(self, name: str, scope: str) -> bool:
        job = Job(self.spark, self.workspace, scope, self.params, {})
        return any(job.rows(f.format(scope=scope)) for f in self.registry[name].reviewed)

    def run(self, name: str, scope: str, pins: dict[str, str] | None = None, acks: tuple[str, ...] = (), reviewed_by: str | None = None) -> int:
        """Build and publish a stage, or reuse the published version with the same identity."""
        if name not in self.registry or scope not in self.registry[name].scopes:
            self.store.log(stage=name, scope=scope, exit=UPSTREAM, note="no such stage or scope")
            return UPSTREAM
        stage = self.registry[name]
        try:
            folders, inputs = self.inputs(name, scope, pins)
        except (UpstreamMissing, UpstreamCorrupt) as e:
            self.store.log(stage=name, scope=scope, exit=UPSTREAM, note=str(e))
            return UPSTREAM
        key = self.key(inputs)
        known = self.store.find_published(name, scope, key)
        if known:
            moved = not (self.store.folder(name, scope) / "_latest.json").exists() or self.store.latest(name, scope) != known
            if moved:
                self.store.publish(name, scope, known)
            self.store.log(stage=name, scope=scope, exit=OK, version=known, note="reused, pointer moved" if moved else "reused")
            return OK
        builder = resolve(stage.builders[scope])
        review = self.needs_review(name, scope)
        path = self.store.new_version(name, scope)
        job = Job(self.spark, self.workspace, scope, self.params, folders, self.expect)
        with self.store.building(path):
            try:
                rows = {}
                for table, df in builder(job).items():
                    rows[table] = sinks.write_parquet(df, str(path / table), self.store.assert_writable)
                sinks.write_json({"rows": rows, **job.meta.get("report", {})}, path / "meta.json", self.store.assert_writable)
                if job.meta.get("semantics"):
                    self.store.assert_writable(path / "semantics.yaml")
                    (path / "semantics.yaml").write_text(job.meta["semantics"], encoding="utf-8")
                results = self._check(name, scope, path, folders, job)
            except ContractViolation as e:
                results, rows = [primitives.Result("BUILD", "CONTRACT", "FAIL", str(e), None)], {}
            summary = primitives.summarize(results)
            self._write_checks(path, results)
            unacked = [w for w in summary["warnings"] if w not in acks]
            held = bool(unacked) or (review and not reviewed_by)
            status = "rejected" if summary["blocking"] else "pending" if held else "published"
            outputs = {k: {"sha256": v, "rows": rows.get(k)} for k, v in self.store.hash_outputs(path).items()}
            inherited = sorted({u for p in folders.values() for u in (self.store.manifest(p)["checks"]["unexplained"] + self.store.manifest(p).get("upstream_unexplained", []))})
            self.store.write_manifest(path, {"stage": name, "scope": scope, "status": status, "content_key": key, "code": code_hash(), "params": self.params, "inputs": inputs, "outputs": outputs, "checks": summary, "acks": [{"check": a, "by": reviewed_by} for a in acks], "reviewed_by": reviewed_by, "needs_review": review, "upstream_unexplained": inherited})
        code = OK
        if status == "rejected":
            path, code = self.store.reject(path), CONTRACT
        elif status == "pending":
            code = HELD
        else:
            self.store.publish(name, scope, path.name)
            code = UNEXPLAINED if summary["unexplained"] else OK
        self.store.log(stage=name, scope=scope, exit=code, version=path.name, key=key)
        return code

    def _check(self, name: str, scope: str, path: Path, folders: dict[str, Path], job: Job) -> list[primitives.Result]:
        stage = self.registry[name]
        ref = stage.checks
        if callable(ref):
            return ref(job, path)
        tables = {p.name: self.spark.read.parquet(str(p)) for folder in (*folders.values(), path) for p in folder.iterdir() if p.is_dir() and not p.name.startswith(("_", "."))}
        ctx = contracts.Context(tables, self.params, job.meta.get("rules", {}), self.expect, job.meta, scope, self.baseline, self.deviations, self.workspace / "investigations")
        return contracts.run(ref, ctx)

    def _write_checks(self, path: Path, results: list[primitives.Result]) -> None:
        self.store.assert_writable(path / "checks.json")
        (path / "checks.json").write_text(json.dumps([r.to_dict() for r in results], ensure_ascii=False, indent=1), encoding="utf-8")

    def publish_pending(self, name: str, scope: str, version: str, acks: tuple[str, ...] = (), reviewed_by: str | None = None) -> int:
        """Publish a held version: warnings acknowledged by name, outputs unchanged, review as the build recorded it."""
        path = self.store.version(name, scope, version)
        m = self.store.manifest(path)
        if m["status"] != "pending":
            return CONTRACT
        if not reviewed_by or self.store.verify(path):
            return HELD if not reviewed_by else UPSTREAM
        acked = {a["check"] for a in m["acks"]} | set(acks)
        if [w for w in m["checks"]["warnings"] if w not in acked]:
            return HELD
        with self.store.building(path):
            m |= {"status": "published", "acks": m["acks"] + [{"check": a, "by": reviewed_by} for a in acks], "reviewed_by": reviewed_by}
            self.store.write_manifest(path, m)
        self.store.publish(name, scope, version)
        code = UNEXPLAINED if m["checks"]["unexplained"] else OK
        self.store.log(stage=name, scope=scope, exit=code, version=version, note="published after review")
        return code

    def run_all(self, scope: str, **more) -> int:
        """All stages of a scope in order; a stage that is not published stops those behind it."""
        worst = OK
        for name in self.order():
            if scope in self.registry[name].scopes:
                code = self.run(name, scope, **more)
                if code not in (OK, UNEXPLAINED):
                    return code
                worst = max(worst, code)
        return worst

    def recheck(self, scope: str) -> dict[str, dict]:
        """Published versions checked again as they are: changed files, and the checks' summary."""
        out = {}
        for name in self.order():
            if scope not in self.registry[name].scopes or not (self.store.folder(name, scope) / "_latest.json").exists():
                continue
            path = self.store.version(name, scope)
            folders = {i: self.store.version(i, scope, v) for i, v in self.store.manifest(path)["inputs"]["upstream"].items()}
            job = Job(self.spark, self.workspace, scope, self.params, folders, self.expect)
            prepare = getattr(resolve(self.registry[name].builders[scope]), "prepare", None)
            if prepare:
                prepare(job)
            out[name] = {"changed": self.store.verify(path), "checks": primitives.summarize(self._check(name, scope, path, folders, job))}
        return out

    def status(self) -> list[dict]:
        """State of every stage and scope: UNBUILT, STALE (an input's content moved on) or FRESH, with unexplained differences."""
        rows = []
        for name in self.order():
            for scope in self.registry[name].scopes:
                row = {"stage": name, "scope": scope, "version": None, "state": "UNBUILT", "why": [], "unexplained": []}
                if (self.store.folder(name, scope) / "_latest.json").exists():
                    path = self.store.version(name, scope)
                    m = self.store.manifest(path)
                    why = self._stale(name, scope, m)
                    row |= {"version": path.name, "state": "STALE" if why else "FRESH", "why": why, "unexplained": sorted({*m["checks"]["unexplained"], *m.get("upstream_unexplained", [])})}
                rows.append(row)
        return rows

    def _stale(self, name: str, scope: str, m: dict) -> list[str]:
        stage, why = self.registry[name], []
        now: dict[str, str] = {}
        for i in stage.inputs:
            try:
                now |= {f"{i}/{k}": v["sha256"] for k, v in self.store.manifest(self.store.version(i, scope))["outputs"].items()}
            except UpstreamMissing:
                why.append(f"{i} is not published")
        why += [f"{k} changed" for k in sorted({*now, *m["inputs"]["outputs"]}) if now.get(k) != m["inputs"]["outputs"].get(k)]
        files = self._files(stage, scope)
        why += [f"{k} changed" for k in sorted({*files, *m["inputs"]["files"]}) if files.get(k) != m["inputs"]["files"].get(k)]
        if sha256_json(self.params) != sha256_json(m["params"]):
            why.append("parameters changed")
        return why
