"""Committed result tables: whole batches, days, compaction, readers."""

import __spark_entry__ as entry
from aidmatch.plans import dashboard
from aidmatch.schemas import RESULT_TABLES
from aidmatch.sources.results import ResultTables
from pyspark.sql import functions as F

NUMBERS = "n bigint"


def rows(spark, *values):
    return spark.createDataFrame(list(values), "n bigint, day string").withColumn("day", F.to_date("day"))


def numbers(df):
    return sorted((r.n, str(r.day)) for r in df.collect())


def test_batches_appear_as_a_whole(spark, tmp_path):
    results = ResultTables(spark, str(tmp_path))
    assert numbers(results.read("a", NUMBERS)) == []
    results.write(0, a=rows(spark, (1, "2024-01-01")), b=rows(spark))
    # a run that ended before its commit leaves rows that nobody reads
    rows(spark, (9, "2024-01-01")).write.partitionBy("day").parquet(f"{tmp_path}/a/batch=1-lost")
    results.write(1, a=rows(spark, (2, "2024-01-01"), (3, "2024-01-02")), b=rows(spark, (7, "2024-01-02")))
    # a batch that runs again changes nothing
    results.write(1, a=rows(spark, (2, "2024-01-01"), (3, "2024-01-02")), b=rows(spark, (7, "2024-01-02")))
    assert numbers(results.read("a", NUMBERS)) == [(1, "2024-01-01"), (2, "2024-01-01"), (3, "2024-01-02")]
    assert numbers(results.read("b", NUMBERS)) == [(7, "2024-01-02")]


def test_two_commits_of_one_batch_count_once(spark, tmp_path):
    results = ResultTables(spark, str(tmp_path))
    for _ in range(2):  # as when a second run starts before the first has committed
        results._commit(4, {"a": rows(spark, (1, "2024-01-01"))}, compacted=False)
    assert numbers(results.read("a", NUMBERS)) == [(1, "2024-01-01")]


def test_compaction(spark, tmp_path):
    results = ResultTables(spark, str(tmp_path))
    for k in range(4):
        results.write(k, a=rows(spark, (k, "2024-01-01"), (10 + k, "2024-01-02")))
    before = numbers(results.read("a", NUMBERS))
    results.compact({"a": NUMBERS}, upto=2)
    assert numbers(results.read("a", NUMBERS)) == before
    assert len(results._batches()) == 2 and len(results.read("a", NUMBERS).inputFiles()) == 4
    results.write(2, a=rows(spark, (99, "2024-01-01")))  # compacted already
    results.write(4, a=rows(spark, (5, "2024-01-03")))
    assert numbers(results.read("a", NUMBERS)) == sorted([*before, (5, "2024-01-03")])


def test_a_dated_query_reads_the_folders_of_its_days(spark, tmp_path):
    results = ResultTables(spark, str(tmp_path))
    results.write(0, a=rows(spark, (1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")))
    dated = results.read("a", NUMBERS).filter("day >= '2024-01-02'")
    assert numbers(dated) == [(2, "2024-01-02"), (3, "2024-01-03")]
    plan = dated._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: []" in plan


def test_summaries_over_written_tables(spark, sf_dir, tmp_path):
    """Every summary of the result tables is the same over what several batches have written."""
    done = entry._attempt(spark, sf_dir).saved()
    assert done.counted == {
        "matched": done.matched.count(), "requests_left": done.left.filter("is_help").count(),
        "volunteers_left": done.left.filter("NOT is_help").count(), "dead_requests": done.requests.count(),
        "dead_volunteers": done.volunteers.count(),
    }
    results = ResultTables(spark, str(tmp_path))
    tables = done.tables()
    for k in range(3):
        results.write(k, **{
            name: _utc(df.filter(F.pmod(F.dayofyear("day"), F.lit(3)) == k)) for name, df in tables.items()
        })
    results.compact({name: RESULT_TABLES[name] for name in tables}, upto=1)
    matched, requests, volunteers = (results.read(name, RESULT_TABLES[name]) for name in tables)
    for summary, args in (
        (dashboard.total_messages, 3), (dashboard.match_totals, 3), (dashboard.matches_by_location, 1), (dashboard.matches_by_category, 1),
        (dashboard.avg_urgency_by_category, 2), (dashboard.category_demand, 3),
    ):
        written, direct = (summary(*sides[:args]).collect() for sides in ((matched, requests, volunteers), (done.matched, done.requests, done.volunteers)))
        assert sorted(written) == sorted(direct)
    for summary in (dashboard.unmatched_by_location, dashboard.unmatched_by_category):
        assert summary(requests).collect() == summary(done.requests).collect()


def _utc(df):
    """Times of the test tables have no zone; the tables keep instants."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType.simpleString() == "timestamp_ntz"})
