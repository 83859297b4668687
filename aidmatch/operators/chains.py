"""Windows of a category one after the other, each with what the one before it left over, in one task.

What a window passes on is known only when it is solved, so its successor has to wait,
but categories do not. A task reads the records of its categories by window and holds
those of one window and of what returns to later ones.
"""

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidmatch.operators.assignment import (
    BROADCAST_GROUPS,
    PLACE,
    RECORD,
    WHOLE_TIMES,
    for_tasks,
    outcome_shape,
    outcome_table,
    record_key,
    settle_group,
    urgency,
    with_distance,
)
from aidmatch.operators.leftovers import live_help, live_volunteer
from aidmatch.schemas import PAYLOAD
from aidmatch.workspace import checkpointed

# A window of a category may have at most this many records, inherited ones included (about 300 bytes each).
MAX_CHAIN_ROWS = 1 << 20
# Rows that leave a task at once.
BATCH_ROWS = 10_000


def assign_chains(fresh: DataFrame, step: int, max_attempts: int, until: int | None = None) -> DataFrame:
    """Outcomes of :func:`assign` for every window of ``fresh``, a written table of distinct records, with what it inherits.

    Windows follow each other after ``step`` microseconds; none after ``until`` inherits.
    """
    parts = int(fresh.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = for_tasks(_with_text(fresh)).select(
        "w", "is_help", *RECORD, *PLACE, "first", (-urgency(F.col("nivel_urgencia"))).alias("asks"),
        live_help().alias("live_help"), live_volunteer().alias("live_volunteer"), "text",
    )
    # by range, so that categories with many records do not meet in a task by chance
    rows = rows.repartitionByRange(parts, "categoria").sortWithinPartitions("categoria", "w")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _solve(batches, step, max_attempts, until)

    out = rows.mapInArrow(solve, outcome_shape(rows))
    # the attempts of a record have changed, so has its key
    keys = {side: F.when(F.col(side).isNotNull(), F.col(side).withField("rec_key", record_key(side))) for side in ("help", "volunteer")}
    return with_distance(out.withColumns(keys))


def _with_text(fresh: DataFrame) -> DataFrame:
    """Add ``text``, which the record key is made of but for the attempts, to records that share their id: they may need it to tell their turns."""
    name = ["categoria", "id"]
    shared = checkpointed(fresh.groupBy(*name).agg(F.count("*").alias("records")).filter("records > 1").select(*name))
    count = shared.count()
    if not count:
        return fresh.withColumn("text", F.lit(None).cast("binary"))
    shared = shared.select(*(F.col(c).alias(f"shared_{c}") for c in name), F.lit(True).alias("shared"))
    same = [F.col(c).eqNullSafe(F.col(f"shared_{c}")) for c in name]
    text = F.to_json(F.struct(*(c for c in PAYLOAD if c != "attempts")), WHOLE_TIMES).cast("binary")
    return (
        fresh.join(F.broadcast(shared) if count <= BROADCAST_GROUPS else shared, same, "left")
        .withColumn("text", F.when(F.col("shared"), text)).drop("shared", *(f"shared_{c}" for c in name))
    )


def _solve(batches: Iterator[pa.RecordBatch], step: int, max_attempts: int, until: int | None) -> Iterator[pa.RecordBatch]:
    """Outcomes of records that come by category and window."""
    returning: dict[int, list[pa.Table]] = {}  # by the window that inherits them

    def settle(w: int | None, records: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        rows, helps, seats = settle_group(pa.concat_tables(records).combine_chunks())
        left = np.maximum(helps, seats)[(helps < 0) | (seats < 0)]
        after = None if w is None else w + step
        if after is not None and (until is None or after <= until):
            again = _again(rows.take(left), after, max_attempts)
            if len(again):
                returning.setdefault(after, []).append(again)
        yield from outcome_table(rows, helps, seats).to_batches(BATCH_ROWS)

    def before(w: float) -> Iterator[pa.RecordBatch]:
        while returning and (first := min(returning)) < w:
            yield from settle(first, returning.pop(first))

    category, windows = None, _windows(batches)
    for own, w, records in windows:
        if own != category:
            yield from before(float("inf"))
            category = own
        if w is not None:
            yield from before(w)
            records += returning.pop(w, [])
        yield from settle(w, records)
    yield from before(float("inf"))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, int | None, list[pa.Table]]]:
    """(category, window, records) of each window that has any."""
    at, records = None, []
    for batch in batches:
        w, category = batch.column("w").cast(pa.int64()), batch.column("categoria")
        codes = category.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        times, none = pc.fill_null(w, 0).to_numpy(zero_copy_only=False), w.is_null().to_numpy(zero_copy_only=False)
        ends = np.flatnonzero((codes[1:] != codes[:-1]) | (times[1:] != times[:-1]) | (none[1:] != none[:-1])) + 1
        for low, high in zip([0, *ends.tolist()], [*ends.tolist(), len(batch)]):
            if low == high:
                continue
            own = category[low].as_py(), w[low].as_py()
            if own != at and records:
                yield *at, records
                records = []
            at = own
            records.append(pa.Table.from_batches([batch.slice(low, high - low)]))
    if records:
        yield *at, records


def _again(left: pa.Table, after: int, max_attempts: int) -> pa.Table:
    """Leftover records that return to a window, on the sides they are live on, as ``retries`` has it."""
    attempts = pc.add(pc.fill_null(left["attempts"], 0), pa.scalar(1, left.schema.field("attempts").type))
    left = _with(left, attempts=attempts).filter(pc.less(attempts, max_attempts))
    if "text" in left.column_names and left["text"].null_count < len(left):
        texts = zip(left["rec_key"].to_pylist(), left["text"].to_pylist(), left["attempts"].to_pylist())
        left = _with(left, rec_key=pa.array([key if text is None else _key(text, n) for key, text, n in texts], left.schema.field("rec_key").type))
    sides = []
    for live, is_help in (("live_help", True), ("live_volunteer", False)):
        side = left.filter(left[live])
        start = {c: pa.array(np.full(len(side), after), pa.int64()).cast(side.schema.field(c).type) for c in ("w", "ts")}
        first = side["asks"] if is_help else pa.array(np.zeros(len(side)), side.schema.field("first").type)
        sides.append(_with(side, is_help=pa.array(np.full(len(side), is_help)), first=first, **start))
    return pa.concat_tables(sides)


def _key(text: bytes, attempts: int) -> str:
    """The record key of a record whose other fields give this text."""
    return sha256(text[:-1] + b'%s"attempts":%d}' % (b"" if text == b"{}" else b",", attempts)).hexdigest()


def _with(table: pa.Table, **columns) -> pa.Table:
    for name, values in columns.items():
        at = table.schema.get_field_index(name)
        table = table.set_column(at, table.schema.field(at), values)
    return table
