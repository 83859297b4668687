"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual`` points of a ring; a row belongs to the first point
clockwise of its hash. A shard takes rows up to its capacity, so rows of an arc
whose shard is full continue clockwise to the next shard with room. Capacities
are the even share, so counts differ by one at most.

All rows of one arc have the same way round the ring, so the overflow is worked
out on the counts of the arcs, a table of ``shards * virtual`` rows whatever the
input. Rows are numbered within small cells of an arc; no arc, key or shard is
ever gathered in one task. Adding a shard changes the arcs of its own points and
what overflows, everything else stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aidmatch.llm.common import saved_with_row_id, whole_text
from aidmatch.workspace import checkpointed

VIRTUAL = 128
ROWS_PER_CELL = 50_000
#: What a row weighs besides its text.
ROW_BYTES = 8


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on unsigned 64-bit numbers."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ring(shards: int, virtual: int = VIRTUAL) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the virtual nodes in ring order, and the shard of each."""
    points = sorted(
        (int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "little"), s)
        for s in range(shards) for v in range(virtual)
    )
    return np.array([p for p, _ in points], dtype=np.uint64), np.array([s for _, s in points], dtype=np.int64)


def overflow(counts: np.ndarray, owners: np.ndarray, capacity: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(arc, from rank, to rank, shard, first slot) for the rows of every arc.

    First every arc offers its rows to its own shard, then what is left over to
    the next other shard clockwise, and so on round the ring.
    """
    arcs, shards = len(owners), len(capacity)
    left, done = counts.astype(np.int64).copy(), np.zeros(arcs, dtype=np.int64)
    room, filled = capacity.astype(np.int64).copy(), np.zeros(shards, dtype=np.int64)
    pieces, tried, at = [], [{int(o)} for o in owners], np.arange(arcs)
    for turn in range(shards):
        for arc in np.flatnonzero(left):
            if turn:
                while int(owners[at[arc]]) in tried[arc]:
                    at[arc] = (at[arc] + 1) % arcs
                tried[arc].add(int(owners[at[arc]]))
            shard = int(owners[at[arc]])
            n = int(min(left[arc], room[shard]))
            if n:
                pieces.append((int(arc), int(done[arc]), int(done[arc]) + n, shard, int(filled[shard])))
                left[arc] -= n
                done[arc] += n
                room[shard] -= n
                filled[shard] += n
    return pieces


def shard_rows(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", virtual: int = VIRTUAL) -> DataFrame:
    """Every row of ``docs`` as ``key, size, text_crc32, law, shard, slot, grown_shard``.

    ``slot`` counts from 0 within a shard without gaps. Null keys hash as one
    value; identical rows and rows of one key spread over the cells of their arc
    by their place in the input and are told apart. Null text is empty. An empty
    table gives an empty result. The key is a number.
    """
    spark = docs.sparkSession
    rows = saved_with_row_id(docs.select(
        F.col(key).cast("bigint").alias(key),
        (F.octet_length(whole_text(text)) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(F.encode(whole_text(text), "UTF-8")).alias("text_crc32"),
    ))
    total = rows.count()
    points, owners = ring(shards, virtual)
    cells = max(1, -(-total // (len(owners) * ROWS_PER_CELL)))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = mix64(batch["hashed"].to_numpy(dtype=np.int64).view(np.uint64))
            arc = np.searchsorted(points, at) % len(points)
            row = mix64(batch["row_id"].to_numpy(dtype=np.int64).view(np.uint64))
            yield batch.assign(
                arc=arc.astype(np.int32), cell=(row % np.uint64(cells)).astype(np.int32), place=at.view(np.int64)
            )

    # pandas would turn a column with nulls into floats, so the null is carried apart
    placed = rows.select(
        F.coalesce(key, F.lit(-1)).cast("bigint").alias("hashed"), F.col(key).isNull().alias("no_key"),
        "size", "text_crc32", "row_id",
    ).mapInPandas(
        place, "hashed bigint, no_key boolean, size bigint, text_crc32 bigint, row_id bigint, arc int, cell int, place bigint"
    ).withColumn(key, F.when(~F.col("no_key"), F.col("hashed")))
    counts = checkpointed(placed.groupBy("arc", "cell").agg(F.count("*").alias("n")))
    per_arc = np.zeros(len(owners), dtype=np.int64)
    for arc, n in counts.groupBy("arc").agg(F.sum("n").alias("n")).collect():  # one row per virtual node at most
        per_arc[arc] = n
    capacity = np.full(shards, total // shards) + (np.arange(shards) < total % shards)
    pieces = overflow(per_arc, owners, capacity)

    before = Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("arc", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("arc", "cell").orderBy("place", "row_id")
    ranked = placed.withColumn("nth", F.row_number().over(within)).join(starts, ["arc", "cell"]).withColumn(
        "rank", F.col("start") + F.col("nth") - 1
    )
    # bounded: each turn round the ring ends in a full shard or an empty arc, so shards * (virtual + 1) pieces at most
    plan = F.broadcast(spark.createDataFrame(pieces, "arc int, low bigint, high bigint, shard int, first bigint"))
    return ranked.join(plan, "arc").filter("rank >= low AND rank < high").select(
        key, "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("first") + F.col("rank") - F.col("low")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
