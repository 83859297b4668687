"""Scratch tables and who removes them."""

import time
from pathlib import Path

from aidmatch.workspace import checkpointed, discard, scratch


def _folder(df) -> Path:
    return Path(df.inputFiles()[0].removeprefix("file://").removeprefix("file:")).parent


def test_scratch_removes_what_it_wrote(spark):
    before = checkpointed(spark.range(3))
    with scratch(spark) as keep:
        inside = checkpointed(spark.range(5))
        with scratch(spark) as keep_inner:
            kept_inner = keep_inner(inside.filter("id > 1"))
        kept = keep(kept_inner.filter("id > 2"))
        gone, gone_inner = _folder(inside), _folder(kept_inner)
    assert not gone.exists() and not gone_inner.exists()
    assert before.count() == 3 and kept.count() == 2


def test_discard_removes_one_table(spark):
    one, other = checkpointed(spark.range(3)), checkpointed(spark.range(4))
    folder = _folder(one)
    discard(one)
    assert not folder.exists() and other.count() == 4


def test_one_file_per_task_whatever_the_session_says(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 10)
    try:
        assert len(checkpointed(spark.range(100).coalesce(1)).inputFiles()) == 1
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_dense_tables_are_smaller_and_their_shuffles_go_at_once(spark):
    """The mining of phrases writes its relations so: disk grew with what its finished steps had shuffled."""
    def blocks():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    def size(df):
        return sum(p.stat().st_size for p in _folder(df).glob("*.parquet"))

    rows = spark.range(200_000).selectExpr("id % 1000 AS k", "id * 7919 % 100003 << 30 AS v").repartition(8, "k")
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    plain, setting = checkpointed(rows), spark.conf.get(cleanup, None)
    dense = checkpointed(rows, dense=True)
    assert size(dense) < 0.9 * size(plain)
    assert dense.exceptAll(plain).isEmpty() and plain.exceptAll(dense).isEmpty()
    before = blocks()
    checkpointed(rows, dense=True)
    until = time.time() + 20
    while blocks() > before and time.time() < until:
        time.sleep(0.2)
    assert blocks() <= before
    assert spark.conf.get(cleanup, None) == setting


def test_python_gets_batches_of_bounded_size(spark):
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["bytes", "rows"])

    long = spark.range(0, 3000, 1, 1).selectExpr("repeat(cast(id AS string), 4000) AS text")
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    found = checkpointed(long.mapInArrow(sizes, "bytes bigint, rows bigint")).collect()
    assert sum(r.rows for r in found) == 3000 and max(r.bytes for r in found) < 8 << 20
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
