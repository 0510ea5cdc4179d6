"""Canonical patterns: tags, base references, dispositions, attribution, duplicates, catalog, registries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.errors import ContractViolation
from wayfare.functions import names
from wayfare.operators import joins, sequences


def join_tags(patterns: DataFrame, tags: DataFrame, support_token: str | None = None) -> DataFrame:
    """Patterns with role, base and loop flag of their tags.

    A tag without a pattern is an error.  A pattern without a tag must be a
    support run (its route name has the token), and becomes role ``support``.
    """
    lost = tags.join(patterns.select("pattern_id"), "pattern_id", "left_anti")
    if lost.limit(1).count():
        raise ContractViolation("tags without a pattern")
    t = tags.select("pattern_id", F.col("role").alias("__role"), "base_id", "is_loop", F.lit(True).alias("tagged"))
    out = patterns.join(t, "pattern_id", "left")
    if support_token is not None and out.where(F.col("tagged").isNull() & ~F.contains(F.col("route"), F.lit(support_token))).limit(1).count():
        raise ContractViolation("an untagged pattern is not a support run")
    return out.withColumn("role", F.coalesce("__role", F.lit("support"))).withColumn("tagged", F.coalesce("tagged", F.lit(False))).drop("__role")


DERIVED = ("short_turn", "branch", "detour", "extension")
#: Why a pattern is where it is, by disposition; a disposition without a reason is an error.
REASONS = {
    "canonical": "its role is in the canonical set",
    "support": "untagged support run, counted for its parent route",
    "excl_circular_with_base": "circular pattern that refers to a base, itself included",
    "excl_detour": "derived detour, kept with its trips outside the canonical set",
    "excl_extension": "derived extension, kept with its trips outside the canonical set",
    "excl_duplicate": "tagged twice within one route",
    "excl_anomaly": "isolated fragment",
}


def base_references(rows: DataFrame, max_depth: int = 4) -> DataFrame:
    """Adds ``base_ref`` (null for a main pattern that refers to itself) and ``base_ref_resolved`` (derived roles: the canonical ancestor).

    ``rows`` has pattern_id, role and base_id as it was tagged.
    """
    found = joins.resolve_base(rows.select("pattern_id", "role", "base_id"), "pattern_id", "base_id", "role", max_depth, strict=False)
    found = found.select("pattern_id", F.col("base_id").alias("base_ref"), "root")
    out = rows.join(found, "pattern_id")
    derived = F.col("role").isin(*DERIVED)
    if out.where(derived & F.col("base_ref").isNotNull() & F.col("root").isNull()).limit(1).count():
        raise ContractViolation("a base reference dangles, is too deep or has no canonical ancestor")
    return out.withColumn("base_ref_resolved", F.when(derived, F.col("root")).otherwise(F.col("base_ref"))).drop("root")


def disposition(resolved: DataFrame, canonical_roles: Sequence[str], backbone_roles: Sequence[str]) -> DataFrame:
    """role_scope, in_canonical, in_backbone, disposition and reason of every pattern (base_id as it was tagged)."""
    circular = F.col("role") == "circular"
    scope = F.when(circular & F.col("base_id").isNull(), "circular_baseless").when(circular, "circular_with_base").otherwise(F.col("role"))
    out = resolved.withColumn("role_scope", scope)
    canonical, backbone = F.col("role_scope").isin(list(canonical_roles)), F.col("role_scope").isin(list(backbone_roles))
    what = F.when(F.col("role") == "support", "support").when(canonical, "canonical").otherwise(F.concat(F.lit("excl_"), F.col("role_scope")))
    out = out.withColumns({"in_canonical": canonical, "in_backbone": backbone, "disposition": what})
    if out.where(~F.col("disposition").isin(list(REASONS))).limit(1).count():
        raise ContractViolation("a pattern has an unknown role")
    why = F.create_map(*[F.lit(x) for kv in REASONS.items() for x in kv])
    return out.withColumn("reason", F.try_element_at(why, F.col("disposition")))


def backbone_stops(patterns: DataFrame, pattern_stops: DataFrame) -> DataFrame:
    chosen = patterns.where("in_backbone").select("pattern_id", "route")
    return chosen.join(pattern_stops, "pattern_id", "left").select("route", "pattern_id", "seq", "stop_id")


def attribute_trips(trips: DataFrame, patterns: DataFrame, support_token: str) -> DataFrame:
    """Every trip with the route it counts for: its own, or the parent's for support runs; a missing parent is an error."""
    p = patterns.select("pattern_id", "route", "role")
    out = trips.select("trip_id", "pattern_id").join(p, "pattern_id", "left")
    if out.where("route is null").limit(1).count():
        raise ContractViolation("a trip has no pattern")
    support = F.col("role") == "support"
    out = out.withColumn("attribution", F.when(support, "support").otherwise("tagged")).withColumn("route", F.when(support, names.parent_name(F.col("route"), support_token)).otherwise(F.col("route")))
    regular = p.where("role <> 'support'").select("route").distinct()
    if out.where("attribution = 'support'").join(regular, "route", "left_anti").limit(1).count():
        raise ContractViolation("a support run's parent route is not there")
    return out.select("trip_id", "pattern_id", "route", "role", "attribution")


def support_runs(patterns: DataFrame, support_token: str) -> DataFrame:
    """The support patterns with the route they count for: (pattern_id, base, parent_route, n_trips)."""
    return patterns.where("role = 'support'").select("pattern_id", F.col("route").alias("base"), names.parent_name(F.col("route"), support_token).alias("parent_route"), "n_trips")


def duplicates(keyed: DataFrame) -> DataFrame:
    """Sequences that several routes share: (pattern_key, pattern_ids, routes, n_patterns, policy)."""
    g = keyed.groupBy("pattern_key").agg(sequences.joined_set(F.col("pattern_id")).alias("pattern_ids"), sequences.joined_set(F.col("route")).alias("routes"), F.count(F.lit(1)).alias("n_patterns"), F.countDistinct("route").alias("n_routes"))
    return g.where("n_routes > 1").select("pattern_key", "pattern_ids", "routes", "n_patterns", F.lit("keep_flag").alias("policy"))


def catalog(patterns: DataFrame, base_names: DataFrame) -> DataFrame:
    """Routes from schedule and route list together: (route, has_schedule, lineage, n_patterns, n_trips)."""
    scheduled = patterns.groupBy("route").agg(sequences.joined_set(F.col("lineage")).alias("s_lineage"), F.count(F.lit(1)).alias("n_patterns"), F.sum("n_trips").alias("n_trips"))
    listed = base_names.groupBy("route").agg(sequences.joined_set(F.col("lineage")).alias("l_lineage"))
    j = scheduled.join(listed, "route", "full")
    return j.select("route", F.col("n_patterns").isNotNull().alias("has_schedule"), F.coalesce("s_lineage", "l_lineage").alias("lineage"), F.coalesce("n_patterns", F.lit(0)).alias("n_patterns"), F.coalesce("n_trips", F.lit(0)).alias("n_trips"))


def classify_routes(routes: DataFrame, rules: dict, name: str = "route", patterns: str | None = None, check_counts: bool = True) -> DataFrame:
    """``routes`` with route_class and rule_id; expected counts and the accounting total must hold when checked."""
    pats = F.col(patterns) if patterns else None
    out = routes.withColumn("route_class", names.classify(rules["rules"], F.col(name), pats))
    out = out.withColumn("rule_id", F.concat(F.lit(f"{rules['era']}:"), F.col("route_class")))
    if check_counts:
        seen = {r["route_class"]: r["count"] for r in out.groupBy("route_class").count().collect()}
        wrong = {r["class"]: (seen.get(r["class"], 0), r["expect"]) for r in rules["rules"] if "expect" in r and seen.get(r["class"], 0) != r["expect"]}
        if wrong:
            raise ContractViolation(f"classes with unexpected counts (found, expected): {wrong}")
        total = rules.get("accounting", {}).get("total")
        if total is not None and sum(seen.values()) != total:
            raise ContractViolation(f"{sum(seen.values())} routes where {total} are expected")
    return out


def boundary_prefixes(rules: dict) -> list[str]:
    """Pattern prefixes whose rule flags trips as clipped at a boundary."""
    return [r["rule"].split(":", 1)[1] for r in rules["rules"] if r.get("scope_flag") == "boundary_clipped"]


def pattern_registry(events: DataFrame, trips: DataFrame, master: DataFrame, rules: dict | None = None) -> DataFrame:
    """Patterns of a log: the first non-null name, whether there is none, variant code, class, clipping, trips (0 if none), stops."""
    patterns = events.select("pattern_id").distinct()
    named = events.where("route_name is not null").groupBy("pattern_id").agg(F.min_by("route_name", F.struct("arr_ts", "master_seq", "route_name")).alias("route_name"))
    n_trips = trips.groupBy("pattern_id").agg(F.count(F.lit(1)).alias("n_trips"))
    n_stops = master.groupBy("pattern_id").agg(F.count(F.lit(1)).alias("n_master_stops"))
    out = patterns.join(named, "pattern_id", "left").join(n_trips, "pattern_id", "left").join(n_stops, "pattern_id", "left")
    pid, clipped = F.col("pattern_id").cast("string"), F.lit(False)
    for p in boundary_prefixes(rules) if rules else ():
        clipped = clipped | pid.startswith(p)
    out = out.withColumns({"name_unknown": F.col("route_name").isNull(), "variant_code": names.variant_code(pid), "boundary_clipped": clipped, "n_trips": F.coalesce("n_trips", F.lit(0))})
    if rules:
        classes = route_registry(out, rules).select("route_name", "route_class")
        out = out.join(classes, "route_name", "left")
    else:
        out = out.withColumn("route_class", F.lit(None).cast("string"))
    return out.select("pattern_id", "route_name", "name_unknown", "variant_code", "route_class", "boundary_clipped", "n_trips", "n_master_stops")


def route_registry(patterns: DataFrame, rules: dict, check_counts: bool = False) -> DataFrame:
    """(route_name, route_class, n_patterns, n_trips) of the named patterns."""
    g = patterns.where("route_name is not null").groupBy("route_name").agg(F.collect_set(F.col("pattern_id").cast("string")).alias("__p"), F.count(F.lit(1)).alias("n_patterns"), F.sum("n_trips").alias("n_trips"))
    return classify_routes(g, rules, "route_name", "__p", check_counts).select("route_name", "route_class", "n_patterns", "n_trips")


def main_proposal(patterns: DataFrame) -> DataFrame:
    """Main pattern of each route by two rules that must agree: variant code 0, and most trips.

    ``basis``: ``vc0_missing`` or ``vc0_multiple`` without a single pattern of
    code 0, else ``tie`` if several have the most trips, else ``both`` or
    ``disagree``.  Only ``both`` names a candidate; all others need review.
    """
    p = patterns.where("route_name is not null").withColumn("pid", F.col("pattern_id").cast("string"))
    top = p.withColumn("is_top", F.col("n_trips") == F.max("n_trips").over(Window.partitionBy("route_name")))
    zero = F.col("variant_code") == 0
    g = top.groupBy("route_name").agg(
        F.count(F.lit(1)).alias("n_patterns"),
        F.max("n_trips").alias("n_trips_top"),
        F.count_if("is_top").alias("n_top"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("is_top"), F.col("pid")))), "|").alias("pattern_id_top"),
        F.count_if(zero).alias("n_zero"),
        F.min(F.when(zero, F.col("pid"))).alias("zero_id"),
        F.max(F.when(zero, F.col("n_trips"))).alias("zero_trips"),
    )
    basis = F.when(F.col("n_zero") == 0, "vc0_missing").when(F.col("n_zero") > 1, "vc0_multiple").when(F.col("n_top") > 1, "tie").when(F.col("pattern_id_top") == F.col("zero_id"), "both").otherwise("disagree")
    one, agreed = F.col("n_zero") == 1, basis == "both"
    return g.select("route_name", "n_patterns", F.when(one, F.col("zero_id")).otherwise("").alias("pattern_id_vc0"), F.when(one, F.col("zero_trips")).alias("n_trips_vc0"), "pattern_id_top", "n_trips_top", (F.col("n_top") > 1).alias("top_tie"), basis.alias("basis"), F.when(agreed, F.col("zero_id")).otherwise("").alias("main_candidate"), (~agreed).alias("needs_review"))


def membership(stops: DataFrame, visited: DataFrame) -> DataFrame:
    return joins.flagged_members(stops, "stop_id", visited, "in_schedule")
