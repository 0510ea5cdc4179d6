"""Parameters, read from YAML once per process."""

from __future__ import annotations

import functools
from pathlib import Path

import yaml

HERE = Path(__file__).parent


@functools.lru_cache(maxsize=8)
def load(path: str | None = None) -> dict:
    with open(path or HERE / "defaults.yaml", encoding="utf-8") as f:
        return yaml.safe_load(f)


def rules(era: str, path: str | None = None) -> dict:
    """Classification rules of an era; rules of another era are an error."""
    file = Path(path) if path else HERE / f"rules_{era}.yaml"
    with open(file, encoding="utf-8") as f:
        found = yaml.safe_load(f)
    if found.get("era") != era:
        raise KeyError(f"rules of era {found.get('era')!r} asked for as {era!r}")
    return found
