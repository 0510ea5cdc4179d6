"""Comparison with frozen baselines: MATCH, EXPLAINED or UNEXPLAINED."""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import dataclass
from functools import reduce
from numbers import Real
from pathlib import Path

from wayfare.checks.primitives import Result


@dataclass(frozen=True)
class Deviation:
    """A registered difference: it explains a check only while the measured value stays what it was."""

    id: str
    check: str
    prior: object
    measured: object
    status: str = "hypothesis"
    doc: str = ""
    note: str = ""


def lookup(baseline: dict, key: str):
    """Value at a dotted key; a missing key is an error."""
    return reduce(dict.__getitem__, key.split("."), baseline)


def close(a, b, tolerance: float) -> bool:
    """Numbers up to a tolerance, anything else exactly."""
    if a == b or bool in (type(a), type(b)):
        return a == b
    return isinstance(a, Real) and isinstance(b, Real) and math.isclose(a, b, rel_tol=0, abs_tol=tolerance)


def note(folder: Path, metric: str, check_id: str, observed, expected) -> Path:
    """A file for whoever looks into a difference, named by check and metric.

    The name does not depend on what else is in the folder, so runs side by
    side agree on it; every value that was ever observed is a line of it.
    """
    folder.mkdir(parents=True, exist_ok=True)
    out = folder / f"{check_id}-{hashlib.sha1(metric.encode()).hexdigest()[:8]}.jsonl"
    line = json.dumps({"metric": metric, "check": check_id, "observed": observed, "baseline": expected}, ensure_ascii=False, default=str)
    known = out.read_text(encoding="utf-8").splitlines() if out.exists() else []
    if line not in known:
        out.write_text("\n".join([*known, line, ""]), encoding="utf-8")
    return out


def judge(check_id: str, observed, key: str, baseline: dict, deviations: list[Deviation] = (), tolerance: float = 0, notes: Path | None = None, metric: str | None = None) -> Result:
    """The three-way verdict: as the baseline has it, as a registered deviation has it, or neither."""
    expected = lookup(baseline, key)
    why = {d.measured: d for d in deviations if d.check == check_id}.get(observed)
    if close(observed, expected, tolerance):
        status, remark = "MATCH", ""
    elif why is not None:
        status, remark = "EXPLAINED", f"{why.id} ({why.status})"
    else:
        status, remark = "UNEXPLAINED", str(note(notes, metric or key, check_id, observed, expected)) if notes else ""
    return Result(check_id, "DIFF", status, observed, expected, source=key, note=remark)
