"""Joins with contracts: nearest in a block, radius across blocks, reference chains, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.errors import ContractViolation
from wayfare.functions import geo, names


def assert_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    twice = df.groupBy(*keys).count().where("count > 1").limit(3).collect()
    if twice:
        raise ContractViolation(f"{what}: repeated keys {[tuple(r)[:-1] for r in twice]}")


def one_to_one(left: DataFrame, right: DataFrame, key: str, must: Sequence[str] = ()) -> DataFrame:
    """Left join where the key is unique on both sides and the named right columns are found for every row."""
    assert_unique(left, [key], "left side")
    assert_unique(right, [key], "right side")
    out = left.join(right, key, "left")
    if must and out.where(F.greatest(*[F.col(c).isNull() for c in must]) if len(must) > 1 else F.col(must[0]).isNull()).limit(1).count():
        raise ContractViolation(f"no partner for some {key}")
    return out


def flagged_members(df: DataFrame, key: str, known: DataFrame, out: str) -> DataFrame:
    """``df`` with a flag whether its key is in ``known``."""
    keys = known.select(F.col(key).alias("__known")).distinct()
    return df.join(keys, F.col(key) == F.col("__known"), "left").withColumn(out, F.col("__known").isNotNull()).drop("__known")


def dangling(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """The different non-null child keys that the parent lacks."""
    c = child.select(F.col(child_key).alias("key")).where("key is not null").distinct()
    return c.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def nearest_in_block(rows: DataFrame, stops: DataFrame, row_id: str, name: str, lat: str, lon: str, max_dist_m: float = 1.0, aliases: dict[str, str] | None = None, stop_order: str = "stop_id") -> tuple[DataFrame, DataFrame]:
    """Each row's nearest stop of the same name: (resolved, failures).

    resolved has ``row_id, stop_id, dist_m, via_alias``; failures has ``row_id,
    reason, dist_m`` with reason ``no_name_match`` or ``too_far``.  Of equally
    near stops the first by ``stop_order`` is taken.
    """
    wanted = rows.select(F.col(row_id), names.stop_name(F.col(name), aliases).alias("__name"), (names.stop_name(F.col(name), aliases) != names.stop_name(F.col(name))).alias("via_alias"), F.col(lat).alias("__lat"), F.col(lon).alias("__lon"))
    there = stops.select("stop_id", F.col(stop_order).alias("__order"), names.stop_name(F.col("stop_name")).alias("__name"), F.col("lat").alias("__slat"), F.col("lon").alias("__slon"))
    d = geo.haversine(F.col("__lat"), F.col("__lon"), F.col("__slat"), F.col("__slon"))
    near = wanted.join(there, "__name", "left").withColumn("dist_m", d)
    best = near.groupBy(row_id).agg(F.min(F.struct(F.col("dist_m").isNull().alias("none"), "dist_m", "__order", "stop_id", "via_alias")).alias("b"))
    best = best.select(row_id, "b.stop_id", "b.dist_m", "b.via_alias")
    fits = F.col("stop_id").isNotNull() & (F.col("dist_m") <= max_dist_m)
    reason = F.when(F.col("stop_id").isNull(), "no_name_match").otherwise("too_far")
    return best.where(fits), best.where(~fits).select(row_id, reason.alias("reason"), "dist_m")


def radius_pairs(points: DataFrame, radius_m: float, key: str, lat: str = "lat", lon: str = "lon", block: str | None = None) -> DataFrame:
    """All pairs a < b of points within a radius (with ``block``: of one block), by a grid: (a, b, dist_m).

    Rows of the grid are as high as the radius.  The columns of a row are as
    wide as the radius is at the row's end nearest to a pole, seen from both of
    its neighbours, and they close around the date line; a row that comes within
    the radius of a pole is one column.  So a partner is in one of nine cells:
    an equi-join on the cell, exact after the distance test.
    """
    step = radius_m / geo.DEGREE_M * 1.000001
    y, x = F.col(lat), F.col(lon)
    row = F.floor(y / step)

    def columns(r: Column) -> Column:
        """Number of columns of a row: the radius, at its farthest latitude, spans at most one."""
        far = F.greatest(F.abs(r), F.abs(r + 1)) * step + step
        wide = F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(step / 2))) / F.cos(F.radians(F.least(far, F.lit(90.0)))))))
        return F.when(far >= 90.0, F.lit(1.0)).otherwise(F.greatest(F.lit(1.0), F.floor(F.lit(360.0) / (wide * 1.000001))))

    turn = F.pmod(x + 180.0, F.lit(360.0)) / 360.0
    own = [F.col(block).alias("block")] if block else [F.lit(0).alias("block")]
    p = points.select(*own, F.col(key).alias("k"), y.alias("y"), x.alias("x"), row.alias("cy"), turn.alias("turn"))
    p = p.withColumn("n", columns(F.col("cy")))
    p = p.withColumn("cx", F.pmod(F.floor(F.col("turn") * F.col("n")), F.col("n")).cast("long")).drop("n")
    spread = p.withColumn("cy", F.explode(F.array(*[F.col("cy") + i for i in (-1, 0, 1)]))).withColumn("n", columns(F.col("cy")))
    middle = F.floor(F.col("turn") * F.col("n"))
    cells = F.array_distinct(F.array(*[F.pmod(middle + j, F.col("n")).cast("long") for j in (-1, 0, 1)]))
    spread = spread.select("block", F.col("k").alias("b"), F.col("y").alias("yb"), F.col("x").alias("xb"), "cy", F.explode(cells).alias("cx"))
    pairs = p.join(spread, ["block", "cy", "cx"]).where("k < b")
    return pairs.select(F.col("k").alias("a"), "b", geo.haversine(F.col("y"), F.col("x"), F.col("yb"), F.col("xb")).alias("dist_m")).where(F.col("dist_m") <= radius_m)


def block_pairs(points: DataFrame, block: str, key: str, max_dist_m: float | None = None, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Pairs a < b inside a block with their distance, all or up to a limit."""
    left = points.select(F.col(block), F.col(key).alias("a"), F.col(lat).alias("y"), F.col(lon).alias("x"))
    right = points.select(F.col(block), F.col(key).alias("b"), F.col(lat).alias("yb"), F.col(lon).alias("xb"))
    pairs = left.join(right, block).where("a < b").withColumn("dist_m", geo.haversine(F.col("y"), F.col("x"), F.col("yb"), F.col("xb")))
    pairs = pairs.select(block, "a", "b", "dist_m")
    return pairs if max_dist_m is None else pairs.where(F.col("dist_m") <= max_dist_m)


def resolve_base(rows: DataFrame, key: str, base: str, role: str, max_depth: int = 4, strict: bool = True) -> DataFrame:
    """Follow ``base`` references to the main (or base-less circular) row they end in: adds ``root`` and ``hops``.

    A main row that refers to itself counts as without reference; a circular
    row that does so keeps it.  Bounded left joins, one per level; chains that
    are deeper, dangle or end elsewhere are an error when ``strict``, else null.
    """
    own = F.when((F.col(role) == "main") & (F.col(base) == F.col(key)), F.lit(None)).otherwise(F.col(base))
    rows = rows.withColumn(base, own)
    table = rows.select(F.col(key).alias("__k"), F.col(base).alias("__next"), F.col(role).alias("__role")).withColumn("__end", (F.col("__role") == "main") | ((F.col("__role") == "circular") & F.col("__next").isNull()))
    out = rows.withColumn("__at", F.col(base)).withColumn("root", F.lit(None).cast(rows.schema[key].dataType)).withColumn("hops", F.lit(None).cast("int")).withColumn("__lost", F.lit(False))
    for level in range(max_depth + 1):
        out = out.join(table, F.col("__at") == F.col("__k"), "left")
        arrived = F.col("root").isNull() & F.col("__end")
        lost = F.col("root").isNull() & F.col("__at").isNotNull() & F.col("__k").isNull()
        out = out.withColumns({"root": F.when(arrived, F.col("__k")).otherwise(F.col("root")), "hops": F.when(arrived, F.lit(level)).otherwise(F.col("hops")), "__lost": F.col("__lost") | lost})
        out = out.withColumn("__at", F.when(F.col("root").isNull(), F.when(F.col("__next") != F.col("__k"), F.col("__next")))).drop("__k", "__next", "__role", "__end")
    out = out.drop("__at")
    if strict and out.where(F.col(base).isNotNull() & F.col("root").isNull() & (F.col(base) != F.col(key))).limit(1).count():
        raise ContractViolation("a base reference dangles, is too deep or has no canonical ancestor")
    return out.drop("__lost")


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], value_left: Column, value_right: Column, tolerance: float = 0) -> DataFrame:
    """Full outer comparison of two tables: (keys, left_value, right_value, status).

    status is ``equal``, ``differs``, ``left_only`` or ``right_only``.
    """
    a = left.select(*keys, value_left.alias("left_value"), F.lit(True).alias("__l"))
    b = right.select(*keys, value_right.alias("right_value"), F.lit(True).alias("__r"))
    same = F.col("left_value").eqNullSafe(F.col("right_value"))
    if tolerance:
        same = same | (F.abs(F.col("left_value") - F.col("right_value")) <= tolerance)
    status = F.when(F.col("__r").isNull(), "left_only").when(F.col("__l").isNull(), "right_only").when(same, "equal").otherwise("differs")
    return a.join(b, list(keys), "full").select(*keys, "left_value", "right_value", status.alias("status"))


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by an order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
