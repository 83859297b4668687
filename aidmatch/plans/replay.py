"""Batch replay of the retry loop: what a window leaves over enters the next one.

Going through the windows one by one would be one job per window. Instead one
task goes through those of a category, and each is solved once. Where a window may
hold more than a task should, all windows are solved side by side under a guess of
what each inherits, and only those whose inheritance turns out different are solved
again, until none does. A window is right once all before it are, so the end is the
sequential result; in sparse tables a change dies out after a few windows.
"""

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aidmatch.operators.chains import MAX_CHAIN_ROWS, assign_chains
from aidmatch.operators.leftovers import live_help, live_volunteer
from aidmatch.operators.windows import GROUP, dedupe
from aidmatch.plans.attempt import Attempt, attempt
from aidmatch.schemas import MAX_ATTEMPTS, PAYLOAD
from aidmatch.workspace import checkpointed

_COLUMNS = ["w", "is_help", *PAYLOAD, "ts", "lat", "lon"]


def next_window(again: DataFrame, length: str) -> DataFrame:
    """Records that return, arriving at the start of the window after theirs."""
    start = F.col("w") + F.expr(f"INTERVAL {length}")
    return again.withColumns({"w": start, "ts": start}).select(*_COLUMNS)


def micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def steady(windowed: DataFrame, length: str) -> int | None:
    """Microseconds between windows where these are always as many, or None."""
    spark, kind = windowed.sparkSession, dict(windowed.dtypes)["w"]
    utc = kind == "timestamp_ntz" or spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")
    one = spark.range(1).select(F.expr(f"INTERVAL {length}").alias("step"))
    if not utc or not one.dtypes[0][1].startswith("interval ") or "month" in one.dtypes[0][1] or "year" in one.dtypes[0][1]:
        return None
    return one.first()["step"] // timedelta(microseconds=1)


def replay(windowed: DataFrame, length: str, max_attempts: int = MAX_ATTEMPTS, until: int | None = None, **bounds) -> Attempt:
    """The attempt over every window with its inherited records, for windows of ``length``.

    With ``until`` (the start of a window in microseconds), later windows are
    left open: what the last one passes on is among the ``retries`` of the result.
    ``bounds`` are those of :func:`assign`; with any, windows are solved side by side.
    """
    fresh = checkpointed(dedupe(windowed).select(*_COLUMNS))
    step = F.expr(f"INTERVAL {length}")
    # A record is in a window once on each side, and returns to at most so many windows after its own:
    # no group outgrows the table, nor that many times the largest group of fresh records.
    sizes = fresh.groupBy(*GROUP).agg(
        F.count("*").alias("rows"), F.min("attempts").alias("attempts"), F.max(live_help() & live_volunteer()).alias("both")
    ).agg(
        F.sum("rows").alias("all"), F.max("rows").alias("most"), F.min("attempts").alias("attempts"), F.max("both").alias("both")
    ).first()
    windows = max(1, max_attempts - min(0, sizes["attempts"] or 0))
    inherited = min((1 + bool(sizes["both"])) * (sizes["all"] or 0), (1 + bool(sizes["both"])) * windows * (sizes["most"] or 0))
    between = steady(windowed, length)
    if not bounds and between and inherited <= MAX_CHAIN_ROWS:
        return Attempt(assign_chains(fresh, between, max_attempts, until), max_attempts)
    bounds = {"most_rows": min(sizes["all"] or 0, 2 * windows * (sizes["most"] or 0)), **bounds}

    def passed_on(records: DataFrame) -> DataFrame:
        again = next_window(attempt(records, max_attempts, **bounds).retries, length)
        return again if until is None else again.filter(micros("w") <= until)

    carried = checkpointed(passed_on(fresh))
    dirty = checkpointed(carried.select(*GROUP).distinct())
    while not dirty.isEmpty():
        inputs = fresh.unionByName(carried).join(dirty, GROUP, "left_semi")
        after = dirty.withColumn("w", F.col("w") + step)
        redone = checkpointed(passed_on(inputs))
        before = carried.join(after, GROUP, "left_semi")
        changed = (
            redone.withColumn("side", F.lit(1))
            .unionByName(before.withColumn("side", F.lit(-1)))
            .groupBy(*_COLUMNS)
            .agg(F.sum("side").alias("difference"))
            .filter("difference <> 0")
        )
        dirty = checkpointed(changed.select(*GROUP).distinct())
        carried = checkpointed(carried.join(after, GROUP, "left_anti").unionByName(redone))
    return attempt(fresh.unionByName(carried), max_attempts, **bounds)
