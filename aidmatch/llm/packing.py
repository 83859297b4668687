"""Pack token sequences by the sum-of-squares rule.

Documents become token pieces of at most ``capacity``; pieces are dealt at
random to buckets of bounded size and each bucket is packed by itself. A piece
goes where the sum over all residual gaps of (open bins with that gap) squared
becomes smallest; a new bin is one of the choices.

The rule packs an unknown future. Here a bucket is known, so the rule is run
over a few orders in which small pieces come late and can close what large ones
leave, and bins that stay open are taken apart and packed again by the same
rule. It stops at the lower bound, the bucket's tokens divided by the capacity.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidmatch.llm.common import saved_with_row_id, whole_text

CAPACITY = 2048
#: Pieces of a bucket on average; one bucket is one task's work.
BUCKET = 50_000
SEPARATOR = 0
ROUNDS = 6
#: Pieces up to these sizes are held back, large ones falling or shuffled before them.
HELD_BACK = (256, 128, 512, 1024)


#: The list of a vocabulary file that names its special tokens, which ends with the first bracket outside a string.
_ADDED = re.compile(r'"added_tokens"\s*:\s*(\[(?:[^]"]|"(?:[^"\\]|\\.)*")*\])')


def special_tokens(vocabulary: str) -> list[str]:
    """The special tokens of a vocabulary file of the tokenizers library, without building its tables."""
    with open(vocabulary, encoding="utf-8") as lines:
        found = _ADDED.search(lines.read())
    return [t["content"] for t in json.loads(found[1])] if found else []


@lru_cache(maxsize=2)
def _whole(vocabulary: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


@lru_cache(maxsize=2)
def _tokenizer(vocabulary: str, ranks: str):
    """An encoder for the vocabulary: its ranks for speed, the vocabulary itself, built only then, where a text names a special token."""
    import public_tokenizers
    import tiktoken

    special = special_tokens(vocabulary)
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return _whole(vocabulary).encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def token_pieces(docs: DataFrame, vocabulary: str, ranks: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): every document's ids and a separator, cut to ``capacity``.

    The first piece of a cut document is the short one. ``vocabulary`` is a
    byte-level BPE file of the tokenizers library, ``ranks`` the same vocabulary
    as merge ranks; both must be readable at these paths on every executor.
    Null and empty texts give one piece, the separator alone.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids array<int>" if with_ids else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(vocabulary, ranks)
        for batch in batches:
            rows, pieces = [], []
            for row, text in enumerate(batch.column(1)):
                ids = np.array([*encode(text.as_py()), SEPARATOR], dtype="<u4")
                start, nth = 0, 0
                while start < len(ids):
                    size = (len(ids) - start - 1) % capacity + 1
                    part = ids[start:start + size]
                    rows.append(row)
                    pieces.append((nth, start, size, zlib.crc32(part.tobytes()), *([part.astype("<i4")] if with_ids else [])))
                    start, nth = start + size, nth + 1
            columns = list(zip(*pieces)) or [()] * (5 if with_ids else 4)
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(columns) + 1],
            )

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(cut, schema)


def place(sizes: np.ndarray, order: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins, as lists of positions in ``sizes``, after placing pieces in this order by the sum-of-squares rule."""
    count = np.zeros(capacity + 1, dtype=np.int64)  # open bins by residual gap
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    for i in order.tolist():
        size = int(sizes[i])
        before = count[size:]
        change = 2 * (count[:capacity + 1 - size] - before) + 2
        change[0] = 1 - 2 * before[0]  # a full bin has no gap to count
        change[before == 0] = np.iinfo(np.int64).max
        best = int(change.argmin())
        fresh = 2 * int(count[capacity - size]) + 1 if size < capacity else 0
        if change[best] <= fresh:
            gap = size + best
            bin_ = open_[gap].pop()
            count[gap] -= 1
        else:
            gap, bin_ = capacity, len(bins)
            bins.append([])
        bins[bin_].append(i)
        if gap > size:
            count[gap - size] += 1
            open_[gap - size].append(bin_)
    return bins


def _orders(sizes: np.ndarray, items: np.ndarray, chance: np.random.Generator) -> Iterator[np.ndarray]:
    for limit in HELD_BACK:
        large, small = items[sizes[items] > limit], items[sizes[items] <= limit]
        falling = np.argsort(-sizes[large], kind="stable"), np.argsort(-sizes[small], kind="stable")
        yield np.concatenate([large[falling[0]], chance.permutation(small)])
        yield np.concatenate([chance.permutation(large), small[falling[1]]])


def pack_sizes(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Few bins for the pieces of a bucket; the same sizes always give the same bins."""
    chance = np.random.default_rng(len(sizes))
    closed: list[list[int]] = [[i] for i in np.flatnonzero(sizes == capacity).tolist()]
    items, best = np.flatnonzero(sizes < capacity), None
    for _ in range(ROUNDS):
        if not len(items):
            return closed
        bound = -(-int(sizes[items].sum()) // capacity)
        shorter = False
        for order in _orders(sizes, items, chance):
            bins = place(sizes, order, capacity)
            if best is None or len(bins) < len(best):
                best, shorter = bins, True
            if len(best) == bound:
                return closed + best
        if not shorter:
            break
        full = [sum(int(sizes[i]) for i in b) == capacity for b in best]
        closed += [b for b, f in zip(best, full) if f]
        best = [b for b, f in zip(best, full) if not f]
        items = np.array([i for b in best for i in b], dtype=np.int64)
    return closed + best


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, bucket: int = BUCKET) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    Sequences are filled from 0 without gaps. Buckets go by the place of a piece
    in the written table, so identical rows spread like any others.
    """
    placed = saved_with_row_id(pieces)
    buckets = max(1, -(-placed.count() // bucket))
    dealt = placed.select(
        "row_id", F.col("length").cast("int").alias("length"), F.pmod(F.xxhash64("row_id"), F.lit(buckets)).alias("bucket")
    )

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "row_id"])
        sizes = group["length"].to_numpy()
        sequence, offset = np.empty(len(sizes), dtype=np.int64), np.empty(len(sizes), dtype=np.int64)
        for nth, members in enumerate(pack_sizes(sizes, capacity)):
            sequence[members] = (int(key[0]) << 32) + nth
            offset[members] = np.cumsum(sizes[members]) - sizes[members]
        return pd.DataFrame({"row_id": group["row_id"], "sequence_id": sequence, "offset": offset})

    where = dealt.groupBy("bucket").applyInPandas(pack, "row_id bigint, sequence_id bigint, offset bigint")
    return placed.join(where, "row_id").drop("row_id")


def pack_documents(docs: DataFrame, vocabulary: str, ranks: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Token pieces of all documents with their sequence and place in it.

    Null texts count as empty, null and repeated ids keep their rows, other
    columns play no part, an empty table gives an empty result.
    """
    return pack_pieces(token_pieces(docs, vocabulary, ranks, capacity, with_ids), capacity)
