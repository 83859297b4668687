"""Exact duplicates by a cuckoo-filter index of live digests.

Every row becomes a SHA-256 of its normalised text. Digests are dealt by their
value to buckets; each bucket keeps a cuckoo filter of 16-bit fingerprints and,
beside it, the whole digests that are live. A digest that misses the filter is
new; one that hits is verified against the stored digests, since a fingerprint
may be another digest's. A filter that overflows is rebuilt at twice the size
from the stored digests.

Copies are folded where they are read, by the same index over one task's rows,
so a text that a third of all rows share crosses the network once per task.
An index is a table of live digests and can be kept: ``apply_changes`` adds and
withdraws documents later.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidmatch.llm.common import SPACE, numbered_documents, parts_for, rows_times, saved_with_row_id, whole_text
from aidmatch.workspace import checkpointed, scratch

LIVE = "digest binary, keep_id bigint, keep_row bigint, group_size bigint"
KEEP, ADD, WITHDRAW = 0, 1, 2
#: A task hands on what it has folded at this many digests, which bounds its memory.
FOLD_LIMIT = 200_000
DIGESTS_PER_BUCKET = 250_000


class CuckooIndex:
    """A cuckoo filter over 32-byte digests with the live digests and their values beside it."""

    SLOTS = 4
    KICKS = 200

    def __init__(self, buckets: int = 1 << 10):
        self.live: dict[bytes, list] = {}
        self._reset(buckets)

    def _reset(self, buckets: int):
        self.mask = buckets - 1
        self.slots = [0] * (buckets * self.SLOTS)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        print_ = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:8], "little") & self.mask
        return print_, first, self._other(first, print_)

    def _other(self, bucket: int, print_: int) -> int:
        return (bucket ^ (print_ * 0x5BD1E995 >> 5)) & self.mask

    def may_hold(self, digest: bytes) -> bool:
        print_, a, b = self._places(digest)
        n = self.SLOTS
        return print_ in self.slots[a * n:a * n + n] or print_ in self.slots[b * n:b * n + n]

    def get(self, digest: bytes) -> list | None:
        """The value of a live digest: the filter answers first, the stored digests verify a hit."""
        return self.live.get(digest) if self.may_hold(digest) else None

    def insert(self, digest: bytes, value: list):
        self.live[digest] = value
        if not self._place(digest):
            self._grow()

    def delete(self, digest: bytes) -> bool:
        """Take out a live digest and one copy of its fingerprint; False if it is not live."""
        if self.get(digest) is None:
            return False
        del self.live[digest]
        print_, a, b = self._places(digest)
        for bucket in (a, b):
            for at in range(bucket * self.SLOTS, (bucket + 1) * self.SLOTS):
                if self.slots[at] == print_:
                    self.slots[at] = 0
                    return True
        raise AssertionError("a live digest had no fingerprint")

    def _place(self, digest: bytes) -> bool:
        print_, a, b = self._places(digest)
        n, slots = self.SLOTS, self.slots
        for bucket in (a, b):
            for at in range(bucket * n, bucket * n + n):
                if not slots[at]:
                    slots[at] = print_
                    return True
        bucket = a
        for kick in range(self.KICKS):
            at = bucket * n + (print_ + kick) % n
            print_, slots[at] = slots[at], print_
            bucket = self._other(bucket, print_)
            for at in range(bucket * n, bucket * n + n):
                if not slots[at]:
                    slots[at] = print_
                    return True
        return False

    def _grow(self):
        size = self.mask + 1
        while True:
            size *= 2
            self._reset(size)
            if all(self._place(digest) for digest in self.live):
                return


def _first(a: list, b: list) -> bool:
    """Does the row (id, row) of ``a`` come before that of ``b``; null ids come last."""
    return (a[0] is None, a[0] or 0, a[1] is None, a[1] or 0) < (b[0] is None, b[0] or 0, b[1] is None, b[1] or 0)


def _merge(index: CuckooIndex, digest: bytes, value: list):
    found = index.get(digest)
    if found is None:
        index.insert(digest, value)
    else:
        if _first(value, found):
            found[:2] = value[:2]
        found[2] += value[2]


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list]]:
    columns = (batch.column(name).to_pylist() for name in ("digest", "keep_id", "keep_row", "group_size"))
    for digest, id_, row, n in zip(*columns):
        yield digest, [id_, row, n]


def _table(index: CuckooIndex) -> Iterator[pa.RecordBatch]:
    digests, values = list(index.live), list(index.live.values())
    for at in range(0, len(digests), 50_000):
        part = values[at:at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests[at:at + 50_000], pa.binary()), *(pa.array([v[i] for v in part], pa.int64()) for i in range(3))],
            names=["digest", "keep_id", "keep_row", "group_size"],
        )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for batch in batches:
        for digest, value in _rows(batch):
            _merge(index, digest, value)
            if len(index.live) >= FOLD_LIMIT:
                yield from _table(index)
                index = CuckooIndex()
    yield from _table(index)


def _collect_live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for batch in batches:
        for digest, value in _rows(batch):
            _merge(index, digest, value)
    yield from _table(index)


def _change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come with live digests first, then additions, then withdrawals."""
    index = CuckooIndex()
    for batch in batches:
        for op, (digest, value) in zip(batch.column("op").to_pylist(), _rows(batch)):
            if op != WITHDRAW:
                _merge(index, digest, value)
                continue
            found = index.get(digest)
            if found is None:
                continue
            found[2] -= value[2]
            if found[2] <= 0:
                index.delete(digest)
            elif found[0] == value[0]:
                found[0] = found[1] = None
    yield from _table(index)


def with_digest(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``digest``: SHA-256 of the text with every run of white space as one space; null counts as empty."""
    return docs.withColumn("digest", F.unhex(F.sha2(F.regexp_replace(whole_text(text), SPACE, " "), 256)))


def live_digests(rows: DataFrame, buckets: int) -> DataFrame:
    """One row per distinct digest of ``rows`` (doc_id, digest, row_id): the first row and the number of rows."""
    single = rows.select(
        "digest", F.col("doc_id").cast("bigint").alias("keep_id"), F.col("row_id").alias("keep_row"),
        F.lit(1).cast("bigint").alias("group_size"),
    )
    return single.mapInArrow(_fold, LIVE).repartition(buckets, "digest").mapInArrow(_collect_live, LIVE)


def apply_changes(live: DataFrame, added: DataFrame, withdrawn: DataFrame, buckets: int) -> DataFrame:
    """The index after adding and withdrawing documents (doc_id, digest, row_id).

    Withdrawing a document that is not live changes nothing. Where the row that
    stays is withdrawn and copies remain, ``keep_id`` is null until
    ``new_keepers`` names the next one.
    """
    def change(df, op):
        return df.select(
            "digest", F.col("doc_id").cast("bigint").alias("keep_id"), F.col("row_id").alias("keep_row"),
            F.lit(1).cast("bigint").alias("group_size"), F.lit(op).alias("op"),
        )

    rows = live.withColumn("op", F.lit(KEEP)).unionByName(change(added, ADD)).unionByName(change(withdrawn, WITHDRAW))
    return rows.repartition(buckets, "digest").sortWithinPartitions("op").mapInArrow(_change, LIVE)


def new_keepers(live: DataFrame, rows: DataFrame) -> DataFrame:
    """Fill missing keepers of ``live`` from the rows (doc_id, digest, row_id) that remain."""
    open_ = live.filter("keep_row IS NULL").select("digest")
    first = rows.join(open_, "digest", "left_semi").groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").cast("bigint").alias("id"), "row_id")).alias("first")
    )
    return live.join(first, "digest", "left").select(
        "digest", F.coalesce("keep_id", "first.id").alias("keep_id"),
        F.coalesce("keep_row", "first.row_id").alias("keep_row"), "group_size",
    )


def exact_dedup(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Of rows with equal text exactly one is kept: the smallest ``doc_id``, null
    ids last, and of identical rows any one. An empty table gives an empty
    result; columns of ``docs`` other than ``doc_id`` and ``text`` play no part.
    """
    rows = saved_with_row_id(with_digest(docs.select("doc_id", text), text).select("doc_id", "digest"))
    buckets = parts_for(docs.sparkSession, rows.count(), DIGESTS_PER_BUCKET)
    live = live_digests(rows, buckets)
    return rows.join(live, "digest").select(
        "doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the copies, all columns as they were; documents are neither written nor shuffled for it."""
    spark = docs.sparkSession
    rows = numbered_documents(docs)
    with scratch(spark) as keep:
        digests = checkpointed(with_digest(rows.select("doc.doc_id", f"doc.{text}", "row_id"), text).select("doc_id", "digest", "row_id"))
        buckets = parts_for(spark, digests.count(), DIGESTS_PER_BUCKET)
        kept = keep(live_digests(digests, buckets).select(F.col("keep_row").alias("row_id"), F.lit(1).alias("copies")))
    return rows_times(rows, kept).select("doc.*")
