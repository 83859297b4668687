"""The matching job on streams: windows, attempt, tables, events and retries."""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aidmatch.operators.assignment import with_record_key
from aidmatch.operators.leftovers import day, outcome_counts
from aidmatch.plans.attempt import Attempt, attempt
from aidmatch.plans.replay import micros, next_window, replay
from aidmatch.schemas import MATCH_EVENT, MAX_ATTEMPTS, PAYLOAD, RESULT_TABLES, WINDOW_LENGTH
from aidmatch.sources.messages import encode, encode_record, parse, quarantine, read_messages, sound
from aidmatch.sources.results import ResultTables
from aidmatch.sources.sinks import publish
from aidmatch.streaming.notifications import payloads


@dataclass
class StreamConfig:
    """Where the job reads and writes.

    ``help_source`` and ``volunteer_source`` are reader options, and the
    ``*_sink`` ones writer options of :func:`publish`; leftovers return through
    ``help_retry`` and ``volunteer_retry``, which must lead to the sources.

    ``watermark_scope`` is ``"source"`` (a lagging stream holds windows open,
    as long as both keep sending) or ``"union"`` (one clock for both; a lagging
    stream can lose records as late, but an idle one holds nothing up). A window
    closes when the clock is ``delay`` past its end.

    ``retry_clock`` says when leftovers are tried again. ``"now"``, for live
    streams: they are published to the retry sinks with the current time.
    ``"window"``, when the past is replayed: by then the clock can be far past
    the next window, so they do not return through the sources, where they could
    be dropped as late. A batch takes them from window to window up to the last
    one that it closes, and the rest wait in a table for the next batch.
    """

    tables: str
    checkpoint: str
    help_source: dict
    volunteer_source: dict
    events_sink: dict
    help_retry: dict
    volunteer_retry: dict
    source_format: str = "parquet"
    window: str = WINDOW_LENGTH
    delay: str = "30 seconds"
    watermark_scope: str = "source"
    retry_clock: str = "now"
    max_attempts: int = MAX_ATTEMPTS
    urgencia_alias: bool = False
    bounds: dict = field(default_factory=dict)
    #: Called with the id of a batch and what was counted in it, when its tables are committed.
    on_batch: Callable[[int, dict[str, int]], None] | None = None


def _parsed(spark: SparkSession, cfg: StreamConfig, options: dict) -> DataFrame:
    raw = read_messages(spark, cfg.source_format, streaming=True, **options)
    return parse(raw, cfg.urgencia_alias)


def windowed_stream(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """Distinct records of both streams, each once, when its window has closed.

    The state is one row per distinct record, spread by the whole record, so a
    crowded category or window is never one row of state.
    """
    sides = [sound(_parsed(spark, cfg, options)) for options in (cfg.help_source, cfg.volunteer_source)]
    if cfg.watermark_scope == "source":
        sides = [side.withWatermark("ts", cfg.delay) for side in sides]
    both = sides[0].unionByName(sides[1])
    if cfg.watermark_scope == "union":
        both = both.withWatermark("ts", cfg.delay)
    keys = ["is_help", *PAYLOAD, "lat", "lon"]
    closed = both.groupBy(F.window("ts", cfg.window).alias("span"), *keys).agg(F.min("ts").alias("ts"))
    return closed.select(F.col("span.start").alias("w"), *keys, "ts")


def process_batch(batch: DataFrame, batch_id: int, cfg: StreamConfig) -> None:
    """The windows that closed; every output is keyed by the batch id."""
    batch = batch.persist()
    try:
        if cfg.retry_clock == "window":
            _replay_batch(batch, batch_id, cfg)
        elif not batch.isEmpty():
            done = attempt(batch, cfg.max_attempts, **cfg.bounds).saved()
            _write(done, batch, batch_id, cfg)
            again = done.retries.withColumn("ts", F.current_timestamp())
            for keep, sink in ((F.col("is_help"), cfg.help_retry), (~F.col("is_help"), cfg.volunteer_retry)):
                publish(encode_record(again.filter(keep), "ts"), batch_id, **sink)
    finally:
        batch.unpersist()


def _replay_batch(batch: DataFrame, batch_id: int, cfg: StreamConfig) -> None:
    """All windows up to the last that closed, with what waits from the batch before.

    Of the waiting records there are two tables in turn: a batch reads the one
    and writes the other, so a batch that is run again finds the same records.
    """
    old, new = (f"{cfg.tables}/waiting/{(batch_id + k) % 2}" for k in (1, 0))
    waiting = batch.limit(0) if batch_id == 0 else batch.sparkSession.read.schema(batch.schema).parquet(old)
    until = batch.agg(F.max(micros("w"))).first()[0]
    if until is None:
        waiting.write.mode("overwrite").parquet(new)
        return
    # windows close in order, so what waits belongs to no later window than this batch's
    both = batch.unionByName(waiting)
    if both.agg(F.min(micros("w"))).first()[0] == until:
        done = attempt(both, cfg.max_attempts, **cfg.bounds).saved()  # one window passes nothing on within the batch
    else:
        done = replay(both, cfg.window, cfg.max_attempts, until=until, **cfg.bounds).saved()
    _write(done, batch, batch_id, cfg)
    last = done.retries.filter(micros("w") == until)
    next_window(last, cfg.window).select(*batch.columns).write.mode("overwrite").parquet(new)


#: Which records went into a window that closed, by a key of the whole record.
CLOSED = "w timestamp, rec_key string"


def _write(done: Attempt, batch: DataFrame, batch_id: int, cfg: StreamConfig) -> None:
    matched = done.matched
    sides = [
        done.outcomes.filter(f"{side} IS NOT NULL").select("w", F.lit(side == "help").alias("is_help"), f"{side}.*")
        for side in ("help", "volunteer")
    ]
    records = sides[0].unionByName(sides[1])
    counts = outcome_counts(records, done.outcomes, cfg.max_attempts)
    # a batch has windows of one day or a few; its counts go with the last
    last = done.outcomes.agg(F.max(day()).alias("day"))
    publish(encode(matched).withColumn("ts", F.current_timestamp()), batch_id, **cfg.events_sink)
    ResultTables(matched.sparkSession, cfg.tables).write(
        batch_id, **done.tables(), outcome_counts=counts.crossJoin(F.broadcast(last)),
        closed=with_record_key(batch).select("w", "rec_key", day()),
    )
    if cfg.on_batch:
        cfg.on_batch(batch_id, done.counted)


def result_table(spark: SparkSession, cfg: StreamConfig, name: str) -> DataFrame:
    """The committed rows of a result table of the job, with the ``day`` of their window."""
    return ResultTables(spark, cfg.tables).read(name, RESULT_TABLES[name])


def run_arrivals(spark: SparkSession, cfg: StreamConfig, **trigger) -> StreamingQuery:
    """Keep every usable record with its window, so that late ones can be told, see :func:`late_records`."""
    sides = [sound(_parsed(spark, cfg, options)) for options in (cfg.help_source, cfg.volunteer_source)]
    placed = sides[0].unionByName(sides[1]).withColumn("w", F.window("ts", cfg.window)["start"])
    rows = with_record_key(placed).select("w", "rec_key", "is_help", *PAYLOAD, "ts")
    return _to_table(rows, f"{cfg.tables}/arrivals", f"{cfg.checkpoint}/arrivals", trigger)


def late_records(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """Records that were read but came after their window had closed.

    A window has closed when a record of it or of a later one went through the
    job. Of what arrived, the records of closed windows are among the outcomes or
    here, all others still wait for their window.
    """
    closed = ResultTables(spark, cfg.tables).read("closed", CLOSED).drop("day")
    arrived = spark.read.parquet(f"{cfg.tables}/arrivals")
    last = F.broadcast(closed.agg(F.max("w").alias("last")))
    over = arrived.join(last, F.col("w") <= F.col("last")).drop("last")
    return over.join(closed, ["w", "rec_key"], "left_anti")


def run_stream(spark: SparkSession, cfg: StreamConfig, **trigger) -> StreamingQuery:
    """Start the job; ``trigger`` is passed on, such as ``processingTime="10 seconds"``."""
    writer = windowed_stream(spark, cfg).writeStream.outputMode("append")
    if trigger:
        writer = writer.trigger(**trigger)
    return (
        writer.option("checkpointLocation", f"{cfg.checkpoint}/match")
        .foreachBatch(lambda batch, batch_id: process_batch(batch, batch_id, cfg))
        .start()
    )


def run_quarantine(spark: SparkSession, cfg: StreamConfig, **trigger) -> StreamingQuery:
    """Keep unusable messages, with the reason, in a table of their own."""
    sides = [quarantine(_parsed(spark, cfg, options)) for options in (cfg.help_source, cfg.volunteer_source)]
    return _to_table(sides[0].unionByName(sides[1]), f"{cfg.tables}/quarantine", f"{cfg.checkpoint}/quarantine", trigger)


def run_notifications(spark: SparkSession, cfg: StreamConfig, source: dict, **trigger) -> StreamingQuery:
    """Turn the match events of ``source`` into notification payloads."""
    events = read_messages(spark, cfg.source_format, streaming=True, **source)
    rows = events.select(F.from_json(F.col("value").cast("string"), MATCH_EVENT).alias("m")).select("m.*")
    return _to_table(payloads(rows), f"{cfg.tables}/notifications", f"{cfg.checkpoint}/notifications", trigger)


def _to_table(df: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
