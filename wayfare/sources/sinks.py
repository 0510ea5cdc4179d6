"""Writing tables, metadata and samples, guarded by the write policy."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

BOM = "﻿"


def write_parquet(df: DataFrame, path: str, allowed: Callable[[str], None] = lambda p: None) -> int:
    """Write a table and return its number of rows, observed while it is written."""
    allowed(path)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return seen.get["n"]


def write_csv(df: DataFrame, path: str, allowed: Callable[[str], None] = lambda p: None) -> None:
    """A folder with one CSV file whose header begins with a byte order mark (for spreadsheets)."""
    allowed(path)
    first = df.columns[0]
    df.withColumnRenamed(first, BOM + first).coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True).csv(path)


def write_json(values: dict, path: Path, allowed: Callable[[str], None] = lambda p: None) -> None:
    allowed(str(path))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(values, ensure_ascii=False, indent=1, default=str), encoding="utf-8")


def write_sample(df: DataFrame, path: str, limit: int = 200, allowed: Callable[[str], None] = lambda p: None) -> str:
    """At most ``limit`` rows, as evidence of a failed check."""
    write_csv(df.limit(limit), path, allowed)
    return path


def semantics(scope: str, universe: list[str]) -> str:
    """What readers may and may not conclude from hub tables, as YAML text."""
    return (
        f"scope: {scope}\nuniverse: {universe}\n"
        "allowed:\n"
        "  - a place has degree k in the graph of this universe\n"
        "  - a place is CROSSING, TERMINAL or NONE under these thresholds\n"
        "  - degree 0 means that this universe's graph does not see the place\n"
        "forbidden:\n"
        "  - a place of degree 0 is of no use for transfers\n"
        "  - NONE means that no transfer is possible\n"
        "  - a hub class holds whatever universe and parameters are chosen\n"
    )


def row_count(spark, path: str) -> int:
    """Rows of a written table; Parquet answers from its footers."""
    return spark.read.parquet(path).count()


def table_digest(df: DataFrame) -> str:
    """A digest of a table's rows that does not depend on their order."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    r = df.select(h.alias("h")).agg(F.bit_xor("h").alias("x"), F.count(F.lit(1)).alias("n"), F.sum(F.pmod("h", F.lit(2**31 - 1))).alias("s")).first()
    return f"{(r['x'] or 0) & (2**64 - 1):016x}-{r['n']}-{r['s'] or 0}"
