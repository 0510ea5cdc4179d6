"""Contract queries against SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from tests.test_queries import SF, TABLES, rows
from wayfare.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    mine, theirs = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_one_row_per_input(spark, name):
    table = {"op5": "pages", "op8": "pages"}.get(name.split("_")[0], "documents")
    key = {"pages": "page_id", "documents": "doc_id"}[table]
    want = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in QUERIES[name](spark, SF).select(key).collect()} == want


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, None
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF).cache()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        now = {r[0] for r in docs.select("doc_id").collect()}
        assert now and (ids is None or now <= ids)
        ids = now
    assert corpus_pipeline.run(spark, SF).count() == docs.count()
