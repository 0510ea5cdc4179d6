"""Names, identifiers and keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import strip


def base_name(c: Column) -> Column:
    """A route name without its trailing group in parentheses (from the first one that opens)."""
    return strip(F.regexp_replace(c, r"\(.*\)\s*$", ""))


def stop_name(c: Column, aliases: dict[str, str] | None = None) -> Column:
    """A stop name as it is compared: stripped, then replaced by its alias."""
    s = strip(c)
    if not aliases:
        return s
    table = F.create_map(*[F.lit(x) for kv in sorted(aliases.items()) for x in kv])
    return F.coalesce(F.try_element_at(table, s), s)


def lineage(c: Column) -> Column:
    """Source system in an id such as ``BR_ABC1_0001``; null without one."""
    found = F.regexp_extract(c, r"^B[RS]_([A-Z0-9]+)_", 1)
    return F.when(found != "", found)


def sequence_key(stops: Column) -> Column:
    """12 hexadecimal digits that depend on the sequence alone."""
    return F.substring(F.sha1(F.array_join(stops, "|").cast("binary")), 1, 12)


def place_id(prefix: str, name: Column, smallest_member: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha1(F.concat_ws("|", name, smallest_member.cast("string")).cast("binary")), 1, 8))


def padded(n: Column, width: int = 3) -> Column:
    """Zero-filled to ``width``; longer numbers stay whole."""
    s = n.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def trip_uid(day: Column, vehicle: Column, pattern: Column, trip_no: Column) -> Column:
    return F.concat_ws("_", day.cast("string"), vehicle.cast("string"), pattern.cast("string"), padded(trip_no))


def parent_name(base: Column, token: str) -> Column:
    """The route that a support run belongs to: what stands before the token."""
    return strip(F.substring_index(base, token, 1))


def variant_code(pattern: Column) -> Column:
    return F.right(pattern, F.lit(1)).cast("tinyint")


def plain_id(c: Column) -> Column:
    return F.regexp_replace(c, r"\.0$", "")


def has_forbidden(names: Iterable[str], terms: Iterable[str]) -> list[tuple[str, str]]:
    """(name, term) for names that contain a forbidden term, whatever the case."""
    return [(n, t) for n in names for t in terms if t.lower() in n.lower()]


def rule_column(rule: str, name: Column, patterns: Column | None = None) -> Column:
    """A rule such as ``fullmatch:\\d{4}`` as a predicate; an unknown kind is an error."""
    kind, _, value = rule.partition(":")
    if kind == "fallback":
        return F.lit(True)
    if kind == "fullmatch":
        return name.rlike(f"^(?:{value})$")
    if kind == "contains":
        return F.contains(name, F.lit(value))
    if kind == "equals":
        return name == value
    if kind == "in":
        return name.isin(*[v.strip() for v in value.strip("[]").split(",")])
    if kind == "pattern_prefix":
        if patterns is None:
            raise ValueError("pattern_prefix needs the patterns of a name")
        return F.exists(patterns, lambda p: p.startswith(value))
    raise ValueError(f"unknown rule kind {kind!r}")


def classify(rules: Iterable[dict], name: Column, patterns: Column | None = None) -> Column:
    """Class of the first rule that fits."""
    out = F.lit(None).cast("string")
    for r in reversed(list(rules)):
        out = F.when(rule_column(r["rule"], name, patterns), F.lit(r["class"])).otherwise(out)
    return out
