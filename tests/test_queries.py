"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import math

import duckdb
import pytest

from wayfare.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("NaT", "<NA>"):
        return "null"
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    if isinstance(v, (int, float)) or hasattr(v, "item") and not isinstance(v, str):
        try:
            return f"{float(v):.6f}"
        except (TypeError, ValueError):
            return str(v)
    return str(v)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(cell(v) for v in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    mine, theirs = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
