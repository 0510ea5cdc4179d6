"""The place graph: edges, degree, directional arms, lifetime, qualification and their reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.errors import ContractViolation
from wayfare.functions import geo
from wayfare.operators import sequences
from wayfare.sources.scratch import Scratch

MASKS, DOMINANCE = ("masked_global", "subgraph"), ("weak", "strict")
THRESHOLDS = ("crossing_min_degree", "crossing_min_arms", "terminal_min_degree", "terminal_max_arms", "terminal_min_lstar")


def universe_routes(catalog: DataFrame, classes: Sequence[str]) -> DataFrame:
    """The routes whose class is in the universe; an unknown universe (no classes) is an error."""
    if not classes:
        raise KeyError("a universe needs at least one route class")
    return catalog.where(F.col("route_class").isin(list(classes))).select("route").distinct()


def place_steps(backbone: DataFrame, stop_map: DataFrame, routes: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """Consecutive different places of every pattern: (route, pattern_id, seq, from_place, to_place)."""
    rows = backbone if routes is None else backbone.join(routes, "route", "left_semi")
    rows = rows.join(stop_map.select("stop_id", "place_id"), "stop_id", "left")
    if strict and rows.where("place_id is null").limit(1).count():
        raise ContractViolation("a pattern has a stop without a place")
    keys = ("route", "pattern_id")
    kept = sequences.collapsed(rows, keys, ("seq",), "place_id")
    steps = kept.withColumn("to_place", F.lead("place_id").over(Window.partitionBy(*keys).orderBy("seq")))
    return steps.where("to_place is not null").select("route", "pattern_id", "seq", F.col("place_id").alias("from_place"), "to_place")


def edges(steps: DataFrame, places: DataFrame) -> DataFrame:
    """Undirected edges place_a < place_b: n_patterns, n_routes, routes (text), gap_m between centroids."""
    pairs = steps.select("route", "pattern_id", F.least("from_place", "to_place").alias("place_a"), F.greatest("from_place", "to_place").alias("place_b"))
    e = pairs.groupBy("place_a", "place_b").agg(F.countDistinct("pattern_id").alias("n_patterns"), F.countDistinct("route").alias("n_routes"), sequences.joined_set(F.col("route")).alias("routes"))
    at = lambda s: places.select(F.col("place_id").alias(f"place_{s}"), F.col("lat_centroid").alias(f"y{s}"), F.col("lon_centroid").alias(f"x{s}"))
    e = e.join(at("a"), "place_a").join(at("b"), "place_b")
    return e.select("place_a", "place_b", "n_patterns", "n_routes", "routes", geo.haversine(F.col("ya"), F.col("xa"), F.col("yb"), F.col("xb")).alias("gap_m"))


def both_ways(e: DataFrame) -> DataFrame:
    return e.select(F.col("place_a").alias("p"), F.col("place_b").alias("q")).unionByName(e.select(F.col("place_b").alias("p"), F.col("place_a").alias("q")))


def degree(e: DataFrame, places: DataFrame) -> DataFrame:
    """(place_id, D) for all places; 0 without an edge."""
    n = both_ways(e).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    return places.select("place_id").join(n, F.col("place_id") == F.col("p"), "left").select("place_id", F.coalesce("n", F.lit(0)).cast("int").alias("D"))


def bearings(e: DataFrame, places: DataFrame) -> DataFrame:
    """(p, bearing, gap) per neighbour: the circular gap to the next bearing."""
    at = lambda s: places.select(F.col("place_id").alias(s), F.col("lat_centroid").alias(f"y{s}"), F.col("lon_centroid").alias(f"x{s}"))
    b = both_ways(e).join(at("p"), "p").join(at("q"), "q").select("p", "q", geo.bearing(F.col("yp"), F.col("xp"), F.col("yq"), F.col("xq")).alias("bearing"))
    w = Window.partitionBy("p").orderBy("bearing", "q")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return b.withColumn("gap", F.coalesce(F.lead("bearing").over(w), F.first("bearing").over(every) + 360.0) - F.col("bearing")).select("p", "bearing", "gap")


def arms(gaps: DataFrame, places: DataFrame, theta: Sequence[float]) -> DataFrame:
    """(place_id, A_<theta>...) : gaps of at least theta degrees, at least 1 with a neighbour, 0 without."""
    counts = [F.greatest(F.lit(1), F.count_if(F.col("gap") >= t)).alias(f"A_{t:g}") for t in theta]
    n = gaps.groupBy("p").agg(*counts)
    return places.select("place_id").join(n, F.col("place_id") == F.col("p"), "left").select("place_id", *[F.coalesce(f"A_{t:g}", F.lit(0)).cast("int").alias(f"A_{t:g}") for t in theta])


def global_violations(e: DataFrame, k_cap: int) -> DataFrame:
    """:func:`first_violations` of the mask ``masked_global`` alone, in time linear in the edges.

    Every place hands on, level by level, the largest degree within reach and
    the smallest and largest place that has it; a place other than itself has
    as large a degree as its own where the largest is larger, or is equal and
    one of those two places is another.  Minima and maxima are aggregated
    before the shuffle, neighbourhoods are never listed, and levels end when
    nothing changes any more.
    """
    scratch = Scratch(e.sparkSession, "reach")
    both = both_ways(e)
    deg = both.groupBy("p").agg(F.count(F.lit(1)).cast("int").alias("d"))
    # a place hears from itself too, and so keeps what it knows without another join
    hears = scratch.put(both.unionByName(deg.select("p", F.col("p").alias("q"))), "hears")
    none = F.lit(None).cast("int")
    state = scratch.put(deg.select("p", F.struct("d", "p").alias("hi"), F.struct((-F.col("d")).alias("d"), F.col("p")).alias("lo"), F.struct("d", none.alias("weak"), none.alias("strict")).alias("own")), "level0")
    for k in range(1, k_cap + 1):
        said = hears.join(state.withColumnRenamed("p", "q"), "q")
        mine = lambda c: F.max(F.when(F.col("p") == F.col("q"), F.col(c)))
        heard = said.groupBy("p").agg(F.max("hi").alias("hi"), F.min("lo").alias("lo"), mine("own").alias("own"), mine("hi").alias("was_hi"), mine("lo").alias("was_lo"))
        larger = F.col("hi.d") > F.col("own.d")
        other = larger | ((F.col("hi.d") == F.col("own.d")) & ((F.col("hi.p") != F.col("p")) | (F.col("lo.p") != F.col("p"))))
        first = lambda name, fails: F.coalesce(f"own.{name}", F.when(fails, F.lit(k))).alias(name)  # noqa: B023, E731
        moved = (F.col("hi") != F.col("was_hi")) | (F.col("lo") != F.col("was_lo"))
        now = heard.select("p", "hi", "lo", F.struct("own.d", first("weak", larger), first("strict", other)).alias("own"), moved.alias("moved"))
        seen = Observation()
        now = now.observe(seen, F.count_if("moved").alias("moved"), F.count_if(F.col("own.weak").isNull()).alias("open")).drop("moved")
        state = scratch.put(now, f"level{k}")
        scratch.drop(f"level{k - 1}")
        if not seen.get["moved"] or not seen.get["open"]:
            break
    state = state.select("p", "own.weak", "own.strict")
    found = [state.where(f"{name} is not null").select(F.col("p").alias("place_id"), F.lit(MASKS[0]).alias("mask"), F.lit(name).alias("dominance"), F.col(name).alias("fails_at")) for name in ("weak", "strict")]
    return found[0].unionByName(found[1])


def first_violations(e: DataFrame, k_cap: int) -> DataFrame:
    """Where dominance first fails: (place_id, mask, dominance, fails_at); places that never fail up to k_cap are absent.

    A place is compared with all others within k steps.  ``weak`` fails where
    one has a larger degree, ``strict`` where one has as large a degree.  With
    ``masked_global`` degrees are those of the whole graph; with ``subgraph``
    those inside the k-step neighbourhood, where the full degree of a place at
    distance j counts from k = j + 1 on, and at k = j only its neighbours
    within distance j.  Frontiers grow level by level, as joins, and a place
    stops as soon as its weak comparison has failed.
    """
    scratch = Scratch(e.sparkSession, "lifetime")
    adjacent = both_ways(e)
    deg = adjacent.groupBy("p").agg(F.count(F.lit(1)).alias("d"))
    adjacent = scratch.put(adjacent.join(deg, "p").join(deg.select(F.col("p").alias("q"), F.col("d").alias("dq")), "q").select("p", "q", "d", "dq"), "adjacent")
    step = adjacent.select(F.col("p").alias("u"), F.col("q").alias("v"), F.col("dq").alias("dv"))
    levels = [scratch.put(adjacent.select("p", F.col("p").alias("v"), F.col("d").alias("dp"), F.col("d").alias("dv")).distinct().withColumn("k", F.lit(0)), "level0")]
    frontier = levels[0]
    for k in range(1, k_cap + 1):
        reached = frontier.select("p", "dp", F.col("v").alias("u")).join(step, "u").groupBy("p", "v").agg(F.first("dp").alias("dp"), F.first("dv").alias("dv"))
        seen = levels[-1].select("p", "v") if k == 1 else levels[-1].select("p", "v").unionByName(levels[-2].select("p", "v"))
        fresh = scratch.put(reached.join(seen, ["p", "v"], "left_anti").withColumn("k", F.lit(k)), f"level{k}")
        levels.append(fresh)
        if k == k_cap or not fresh.where("dv <= dp").limit(1).count():
            break
        frontier = fresh.join(fresh.where("dv > dp").select("p").distinct(), "p", "left_anti")
    every = levels[0]
    for t in levels[1:]:
        every = every.unionByName(t)
    after = every.where("k > 0")
    first = after.groupBy("p").agg(F.min(F.when(F.col("dv") >= F.col("dp"), F.col("k"))).alias("js"), F.min(F.when(F.col("dv") > F.col("dp"), F.col("k"))).alias("jw"))
    compared = after.where("dv >= dp").join(first, "p").where("k = js or k = jw")
    near = every.select("p", F.col("v").alias("n"), F.col("k").alias("kn"))
    inside = compared.join(adjacent.select(F.col("p").alias("v"), F.col("q").alias("n")), "v").join(near, ["p", "n"]).where("kn <= k").groupBy("p", "v").agg(F.count(F.lit(1)).alias("din"))
    full = compared.join(inside, ["p", "v"], "left").withColumn("din", F.coalesce("din", F.lit(0)))
    hit = full.groupBy("p", "js", "jw").agg(F.max((F.col("k") == F.col("js")) & (F.col("din") >= F.col("dp"))).alias("strict_in"), F.max((F.col("k") == F.col("jw")) & (F.col("din") > F.col("dp"))).alias("weak_in"))
    hit = scratch.put(hit, "hits")
    strict = hit.where("js is not null").select("p", F.col("js").alias("j"), F.col("strict_in").alias("now"))
    weak = hit.where("jw is not null").select("p", F.col("jw").alias("j"), F.coalesce("weak_in", F.lit(False)).alias("now"))
    parts = []
    for name, t in (("strict", strict), ("weak", weak)):
        late = F.col("j") + F.when(F.col("now"), 0).otherwise(1)
        parts += [t.select("p", F.lit("masked_global").alias("mask"), F.lit(name).alias("dominance"), F.col("j").alias("fails_at")), t.select("p", F.lit("subgraph").alias("mask"), F.lit(name).alias("dominance"), late.alias("fails_at"))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return out.withColumnRenamed("p", "place_id")


def lifetimes(violations: DataFrame, degrees: DataFrame, mask: str, dominance: str, k_max: int) -> DataFrame:
    """(place_id, L): the largest k up to k_max at which the place still dominates; 0 without an edge."""
    if mask not in MASKS or dominance not in DOMINANCE:
        raise ValueError(f"unknown mode {mask}, {dominance}")
    v = violations.where((F.col("mask") == mask) & (F.col("dominance") == dominance)).select("place_id", "fails_at")
    value = F.when(F.col("D") == 0, 0).otherwise(F.least(F.lit(k_max), F.coalesce(F.col("fails_at") - 1, F.lit(k_max))))
    return degrees.join(v, "place_id", "left").select("place_id", value.cast("int").alias("L"))


def metrics(degrees: DataFrame, arm_counts: DataFrame, life: DataFrame, places: DataFrame, gate_degree: int = 3) -> DataFrame:
    """(place_id, name_norm, D, A, L, L_star, in_lspace), one row per place."""
    m = places.select("place_id", "name_norm").join(degrees, "place_id").join(arm_counts, "place_id").join(life, "place_id")
    return m.select("place_id", "name_norm", "D", "A", "L", F.when(F.col("D") >= gate_degree, F.col("L")).otherwise(0).alias("L_star"), (F.col("D") >= 1).alias("in_lspace"))


def qualify(m: DataFrame, thresholds: dict) -> DataFrame:
    """(place_id, hub_class, hub_class_rule, is_crossing, is_terminal); crossing wins where both hold."""
    missing = [k for k in THRESHOLDS if k not in thresholds]
    if missing:
        raise KeyError(f"thresholds lack {missing}")
    t = thresholds
    crossing = (F.col("D") >= t["crossing_min_degree"]) & (F.col("A") >= t["crossing_min_arms"])
    terminal = (F.col("D") >= t["terminal_min_degree"]) & (F.col("A") <= t["terminal_max_arms"]) & (F.col("L_star") >= t["terminal_min_lstar"])
    label = F.when(crossing, "CROSSING").when(terminal, "TERMINAL").otherwise("NONE")
    return m.select("place_id", label.alias("hub_class"), label.alias("hub_class_rule"), crossing.alias("is_crossing"), terminal.alias("is_terminal"))


HUB_CLASSES = ("CROSSING", "TERMINAL", "NONE")


def apply_hub_overrides(q: DataFrame, overrides: DataFrame) -> DataFrame:
    """Classes set by hand: overrides (row_no, place_id, hub_class); the last row of a place wins, the rule's class stays beside it.

    An unknown class or place is an error.
    """
    if overrides.where(~F.col("hub_class").isin(*HUB_CLASSES)).limit(1).count():
        raise ContractViolation("an override has an unknown hub class")
    if overrides.join(q.select("place_id"), "place_id", "left_anti").limit(1).count():
        raise ContractViolation("an override refers to an unknown place")
    last = overrides.groupBy("place_id").agg(F.max("row_no").cast("smallint").alias("override_row"), F.max_by("hub_class", "row_no").alias("set_class"))
    out = q.join(last, "place_id", "left").withColumn("hub_class", F.coalesce("set_class", "hub_class_rule"))
    out = out.withColumn("is_override", F.col("override_row").isNotNull())
    return out.select("place_id", "hub_class", "hub_class_rule", "is_crossing", "is_terminal", "is_override", "override_row")


def sensitivity(degrees: DataFrame, arms_by_theta: DataFrame, violations: DataFrame, adopted: dict, grid: dict, thresholds: dict, gate_degree: int = 3) -> DataFrame:
    """Hub counts over the grid: all lifetime variants at the adopted angle, and the other angles at the adopted lifetime."""
    spark = degrees.sparkSession
    base = (adopted["mask"], adopted["dominance"], adopted["k_max"], float(adopted["arm_degrees"]))
    variants = [(m, d, k, base[3]) for m in grid["mask"] for d in grid["dominance"] for k in grid["k_max"]]
    variants += [(*base[:3], float(a)) for a in grid["arm_degrees"] if float(a) != base[3]]
    table = spark.createDataFrame([(f"{m}|{d}|k{k}|theta{a:g}", m, d, k, a, (m, d, k, a) == base) for m, d, k, a in variants], "variant_id string, mask string, dominance string, k_max int, arm_degrees double, is_adopted boolean")
    rows = degrees.join(arms_by_theta, "place_id").crossJoin(F.broadcast(table))
    v = rows.join(violations, ["place_id", "mask", "dominance"], "left")
    angle = F.coalesce(*[F.when(F.col("arm_degrees") == float(a), F.col(f"A_{float(a):g}")) for a in grid["arm_degrees"]])
    life = F.when(F.col("D") == 0, 0).otherwise(F.least(F.col("k_max"), F.coalesce(F.col("fails_at") - 1, F.col("k_max"))))
    v = v.withColumn("A", angle).withColumn("L_star", F.when(F.col("D") >= gate_degree, life).otherwise(0))
    t = thresholds
    crossing = (F.col("D") >= t["crossing_min_degree"]) & (F.col("A") >= t["crossing_min_arms"])
    terminal = ~crossing & (F.col("D") >= t["terminal_min_degree"]) & (F.col("A") <= t["terminal_max_arms"]) & (F.col("L_star") >= t["terminal_min_lstar"])
    keys = ("variant_id", "mask", "dominance", "k_max", "arm_degrees", "is_adopted")
    return v.groupBy(*keys).agg(F.count_if(crossing).alias("n_crossing"), F.count_if(terminal).alias("n_terminal"), F.count_if(crossing | terminal).alias("n_hub_qualified"))


def explain_isolated(m: DataFrame, patterns: DataFrame, pattern_stops: DataFrame, stop_map: DataFrame, routes: DataFrame) -> DataFrame:
    """Why places have no edge: (place_id, name_norm, reason, routes_serving).

    ``patterns`` has pattern_id, route, role, in_backbone.  One cause gives
    ``<cause>_only``, several ``mixed_nonbackbone``, none ``no_pattern``.
    """
    inside = routes.select(F.col("route").alias("__r"))
    p = patterns.join(inside, F.col("route") == F.col("__r"), "left")
    cause = F.when(F.col("__r").isNull(), "out_of_universe").when(F.col("in_backbone"), "backbone_visible").when(F.col("role") == "circular", "uncovered_circular").otherwise("non_backbone_variant")
    p = p.select("pattern_id", "route", cause.alias("cause"))
    served = pattern_stops.select("pattern_id", "stop_id").distinct().join(stop_map.select("stop_id", "place_id"), "stop_id").join(p, "pattern_id").select("place_id", "route", "cause").distinct()
    alone = m.where("D = 0").select("place_id", "name_norm")
    g = alone.join(served, "place_id", "left").groupBy("place_id", "name_norm").agg(F.countDistinct("cause").alias("n"), F.min("cause").alias("cause"), sequences.joined_set(F.col("route")).alias("routes_serving"))
    reason = F.when(F.col("n") == 0, "no_pattern").when(F.col("n") == 1, F.concat(F.col("cause"), F.lit("_only"))).otherwise("mixed_nonbackbone")
    return g.select("place_id", "name_norm", reason.alias("reason"), "routes_serving")


def ranked(m: DataFrame) -> DataFrame:
    """Metrics with rank columns by degree and by lifetime, largest first (a view beside the reference tables).

    Ranks come from the counts of the different values, which are few.
    """
    for column, name in (("D", "rank_degree"), ("L", "rank_lifetime")):
        counts = m.groupBy(F.col(column).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
        before = F.sum("__n").over(Window.orderBy(F.desc("__v")).rowsBetween(Window.unboundedPreceding, -1))
        ranks = counts.select("__v", (F.coalesce(before, F.lit(0)) + 1).cast("int").alias(name))
        m = m.join(ranks, m[column].eqNullSafe(ranks["__v"]), "left").drop("__v")
    return m


def numbered(df: DataFrame, key: str, out: str = "idx", width: int = 6) -> DataFrame:
    """Number rows by a text key from 0: inside groups of the first ``width`` characters, with the counts of the groups before.

    Place ids are hashes behind a fixed prefix of three characters, so six
    characters make 4,096 groups of about equal size.
    """
    group = F.substring(key, 1, width)
    sizes = df.groupBy(group.alias("__g")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__g").rowsBetween(Window.unboundedPreceding, -1))
    first = sizes.select("__g", F.coalesce(before, F.lit(0)).alias("__first"))
    rows = df.withColumn("__g", group).join(F.broadcast(first), "__g")
    inside = F.row_number().over(Window.partitionBy("__g").orderBy(key)) - 1
    return rows.withColumn(out, (F.col("__first") + inside).cast("int")).drop("__g", "__first")


def map_view(places: DataFrame, m: DataFrame, q: DataFrame, gap: DataFrame) -> DataFrame:
    """One row per place with everything a map shows, numbered by place id."""
    v = places.join(m.drop("name_norm"), "place_id").join(q.select("place_id", "hub_class"), "place_id").join(gap.select("place_id", "reason"), "place_id", "left")
    return numbered(v, "place_id")
