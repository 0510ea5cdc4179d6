"""Names that a table or metric must not have."""

from __future__ import annotations

from collections.abc import Iterable

from wayfare import config
from wayfare.checks.primitives import Result, record
from wayfare.functions.names import has_forbidden


def check_names(check_id: str, names: Iterable[str], terms: Iterable[str] | None = None) -> Result:
    found = has_forbidden(names, config.load()["vocabulary"]["forbidden"] if terms is None else terms)
    return record(check_id, "CONTRACT", {"forbidden": found}, {"forbidden": []}, not found)
