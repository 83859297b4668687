"""Rows are told apart whatever the session says about files."""

import pytest
from pyspark.sql import functions as F

from aidmatch.llm.cuckoo_dedup import drop_copies, exact_dedup
from aidmatch.llm.packing import pack_documents
from aidmatch.llm.pareto_mix import mix, repeat_by_mix
from aidmatch.llm.parity_join import keep_one
from aidmatch.llm.queries import vocabulary
from aidmatch.llm.secrets import scan_secrets


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"text number {i // 2} of fifty different ones {i // 2}", "ab"[i % 2], i) for i in range(100)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint").coalesce(1)


@pytest.fixture
def short_files(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 10)
    yield
    spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_short_files(spark, docs, short_files):
    assert sorted(r.doc_id for r in pack_documents(docs, *vocabulary()).collect()) == list(range(100))
    assert exact_dedup(docs).filter("kept").count() == 50
    assert scan_secrets(docs).count() == 100


@pytest.mark.parametrize("as_table", [False, True])
def test_stages_keep_what_they_decide(spark, docs, short_files, tmp_path, as_table):
    if as_table:
        path = str(tmp_path / "docs")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    assert sorted(r.doc_id for r in drop_copies(docs).collect()) == list(range(0, 100, 2))
    kept = keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == list(range(0, 100, 2))
    want = sorted(r.doc_id for r in mix(docs).collect() for _ in range(r.copies))
    assert sorted(r.doc_id for r in repeat_by_mix(docs).collect()) == want
    assert repeat_by_mix(docs).filter(F.col("n_chars") != F.col("doc_id")).count() == 0
