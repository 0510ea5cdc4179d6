"""Command line: run, publish, recheck and status of a workspace."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from wayfare.control.runner import Runner


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m wayfare.control.cli")
    p.add_argument("--workspace", required=True, help="folder that driver and executors share")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run")
    run.add_argument("stage", help="a stage, or all")
    run.add_argument("--scope", required=True, choices=("planned", "actual"))
    run.add_argument("--pin", action="append", default=[], metavar="STAGE=VERSION")
    run.add_argument("--ack", action="append", default=[], metavar="CHECK")
    run.add_argument("--reviewed-by")
    pub = sub.add_parser("publish")
    pub.add_argument("stage")
    pub.add_argument("version")
    pub.add_argument("--scope", required=True)
    pub.add_argument("--ack", action="append", default=[])
    pub.add_argument("--reviewed-by", required=True)
    re = sub.add_parser("recheck")
    re.add_argument("--scope", required=True)
    sub.add_parser("status")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    runner = Runner(spark or SparkSession.builder.appName("wayfare").getOrCreate(), a.workspace)
    if a.command == "run":
        more = {"pins": dict(p.split("=", 1) for p in a.pin), "acks": tuple(a.ack), "reviewed_by": a.reviewed_by}
        return runner.run_all(a.scope, **more) if a.stage == "all" else runner.run(a.stage, a.scope, **more)
    if a.command == "publish":
        return runner.publish_pending(a.stage, a.scope, a.version, tuple(a.ack), a.reviewed_by)
    if a.command == "recheck":
        found = runner.recheck(a.scope)
        print(json.dumps(found, ensure_ascii=False, indent=1))
        return 2 if any(x["changed"] or x["checks"]["blocking"] for x in found.values()) else 0
    for row in runner.status():
        print(f"{row['stage']:<10} {row['scope']:<8} {row['version'] or '-':<6} {row['state']:<8} {'; '.join(row['why'])}{' unexplained: ' + ', '.join(row['unexplained']) if row['unexplained'] else ''}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
