"""Registered queries next to their SQL, and the pipeline's stages."""

import duckdb
import pytest

import corpus_pipeline
from aidmatch.llm.queries import QUERIES, SQL
from tests.oracle import sorted_rows


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    cur = con.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    mine = QUERIES[name](spark, sf_dir)
    assert sorted_rows(mine.columns, mine.collect()) == sorted_rows(columns, cur.fetchall())


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert pieces and {p.doc_id for p in pieces} <= ids
