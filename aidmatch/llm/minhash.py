"""Near duplicates by MinHash: minima of universal hashes, bands, checks, connected components.

The shingle set of a text gets ``HASHES`` minima, one for each of as many
multiply-add-shift hashes. ``ROWS`` minima in a row make a band, and sets that
agree in a whole band are candidates. Two sets at the threshold agree in a minimum
with probability 0.8, so all ``BANDS`` bands miss them with (1 - 0.8 ** 4) ** 32,
less than 5e-8, and sets further apart than that by chance only.

Candidates are checked by the share of minima that agree (the low byte of each is
kept), with a margin of six standard deviations, and then by the whole sets.

Pairs within a band are not listed. Each set of a band is first compared with the
first set of that band; links make components. Where a band still holds several
components, its sets meet those members that agree most with what is common in it,
such as the text that the others were made from. What still lies outside the largest
component of a band is compared with all of the band, by signatures and then by whole
sets that are at hand, and only links are given out. Equal sets count as one, so every link that could join two components is found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aidmatch.llm.common import join_unique, numbered_documents, parts_for, rows_times, whole_text
from aidmatch.llm.components import connected_components
from aidmatch.llm.shingles import mix, shingle_set
from aidmatch.workspace import checkpointed, scratch

WIDTH = 4
#: Two sets link when 100 * |A & B| >= 80 * |A | B|.
PERCENT = 80
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Least share of equal minima of candidates: six standard deviations below the threshold.
ALIKE = 0.8 - 6 * (0.8 * 0.2 / HASHES) ** 0.5
#: A task gives the signature of equal sets once as long as it remembers them.
REMEMBERED = 200_000
#: Members of a band that the sets of its other components meet.
MEET = 8
#: Members of a band that tell what is common in it.
COMMON = 64
#: Bytes of sets of a band in one block, and sets that are compared with one other set in one task.
BLOCK_BYTES, PER_HUB = 1 << 25, 4096

_U = np.uint64
_chance = np.random.Generator(np.random.PCG64(13))
_TIMES = _chance.integers(1, 1 << 63, HASHES, dtype=np.uint64) * _U(2) + _U(1)
_PLUS = _chance.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_BAND = _chance.integers(1, 1 << 63, ROWS, dtype=np.uint64) | _U(1)


def minima(tokens: np.ndarray) -> np.ndarray:
    """The least value of every hash over a set that is not empty, 32 bits each."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(tokens), 512):
        hashed = _TIMES[:, None] * tokens[None, at:at + 512]
        hashed += _PLUS[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    return (least >> _U(32)).astype(np.uint32)


def bands(least: np.ndarray) -> np.ndarray:
    """A key of every band: its number and minima, mixed."""
    sums = (least.astype(np.uint64).reshape(BANDS, ROWS) * _BAND).sum(axis=1, dtype=np.uint64)
    return mix(sums + np.arange(1, BANDS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)).view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, row_id, text) to the digest and size of each set; signature and bands once for equal sets."""
    seen: set[bytes] = set()
    for batch in batches:
        digests, sizes, signatures, keys = [], [], [], []
        for text in batch.column(2):
            tokens = shingle_set(text.as_py(), WIDTH)
            digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None
            digests.append(digest)
            sizes.append(len(tokens))
            if digest is None or digest in seen:
                signatures.append(None)
                keys.append(None)
                continue
            if len(seen) >= REMEMBERED:
                seen.clear()
            seen.add(digest)
            least = minima(tokens)
            signatures.append(least.astype(np.uint8).tobytes())
            keys.append(bands(least))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()),
             pa.array(keys, pa.list_(pa.int64()))],
            names=["doc_id", "row_id", "digest", "n", "signature", "bands"],
        )


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = [shingle_set(t.as_py(), WIDTH).tobytes() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.binary())], names=["sid", "tokens"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (hub, sid) whose sizes and signatures allow a link."""
    for batch in batches:
        if not batch.num_rows:
            continue
        n, m = (np.asarray(batch.column(i)) for i in (2, 3))
        mine, theirs = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(-1, HASHES) for i in (4, 5))
        kept = (np.minimum(n, m) * 100 >= np.maximum(n, m) * PERCENT) & ((mine == theirs).mean(axis=1) >= ALIKE)
        yield batch.select([0, 1]).filter(pa.array(kept))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sets link; rows (hub, lot, member, tokens) come sorted, the hub's own set first."""
    hub, theirs = None, None
    for batch in batches:
        found = []
        for name, member, tokens in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
            mine = np.frombuffer(tokens, dtype=np.uint64)
            if member is None:
                hub, theirs = name, mine
                continue
            assert hub == name
            both = len(np.intersect1d(mine, theirs, assume_unique=True))
            if 100 * both >= PERCENT * (len(mine) + len(theirs) - both):
                found.append((hub, member))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
        )


class _Rest:
    """Sets of a block with their tokens numbered, to count what one set shares with many."""

    def __init__(self, tokens: list[np.ndarray]):
        self.size = np.array([len(t) for t in tokens])
        self.start = np.r_[0, np.cumsum(self.size)[:-1]]
        self.names, self.codes = np.unique(np.concatenate(tokens), return_inverse=True)
        self.mine = np.zeros(len(self.names), dtype=bool)

    def linked(self, tokens: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Which of the rows link with a set."""
        at = np.searchsorted(self.names, tokens)
        at = at[self.names[np.minimum(at, len(self.names) - 1)] == tokens]
        self.mine[at] = True
        size = self.size[rows]
        ends = np.cumsum(size)
        places = np.arange(ends[-1]) + np.repeat(self.start[rows] - ends + size, size)
        both = np.add.reduceat(self.mine[self.codes[places]].astype(np.int64), ends - size)
        self.mine[at] = False
        return 100 * both >= PERCENT * (len(tokens) + size - both)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between sets of a band in different components.

    Rows (band, low, high, asks, sid, part, main, signature, bands, tokens) come sorted by block,
    those that ask first. One that asks is compared with the rest: rows of the
    band's main component, and others with a larger name, so pairs count once; a
    pair that shares several bands counts in the first of them.
    """
    def block(band: int, asking: list, rest: list) -> Iterator[pa.RecordBatch]:
        if not asking or not rest:
            return
        sid, part, main = (np.array([r[i] for r in rest]) for i in (0, 1, 2))
        signature = np.frombuffer(b"".join(r[3] for r in rest), dtype=np.uint8).reshape(-1, HASHES)
        keys = np.array([r[4] for r in rest], dtype=np.int64)
        sets = _Rest([np.frombuffer(r[5], dtype=np.uint64) for r in rest])
        size = sets.size
        joined: dict[int, int] = {}

        def find(x: int) -> int:
            while joined.get(x, x) != x:
                x = joined[x]
            return x

        found = []
        for name, own, _, print_, bands_, raw in asking:
            mine = np.frombuffer(raw, dtype=np.uint64)
            fit = (part != own) & (main | (sid > name)) & (np.minimum(size, len(mine)) * 100 >= np.maximum(size, len(mine)) * PERCENT)
            near = np.flatnonzero(fit)
            near = near[(signature[near] == np.frombuffer(print_, dtype=np.uint8)).mean(axis=1) >= ALIKE]
            shared = keys[near] == np.array(bands_, dtype=np.int64)
            near = near[np.array(bands_)[shared.argmax(axis=1)] == band] if len(near) else near
            for lot in range(0, len(near), 4096):
                some = near[lot:lot + 4096]
                for i in some[sets.linked(mine, some)]:
                    # one link for two components
                    a, b = find(int(own)), find(int(part[i]))
                    if a != b:
                        joined[max(a, b)] = min(a, b)
                        found.append((name, int(sid[i])))
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    last, asking, rest = None, [], []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(10)]
        for *key, asks, sid, part, main, print_, bands_, tokens in zip(*columns):
            if key != last:
                if last is not None:
                    yield from block(last[0], asking, rest)
                last, asking, rest = key, [], []
            (asking if asks else rest).append((sid, part, main, print_, bands_, tokens))
    if last is not None:
        yield from block(last[0], asking, rest)


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most frequent value of every place of a band's signatures."""
    for batch in batches:
        common = []
        for prints in batch.column(1).to_pylist():
            rows = np.frombuffer(b"".join(prints), dtype=np.uint8).reshape(-1, HASHES)
            counts = np.zeros((HASHES, 256), dtype=np.int32)
            np.add.at(counts, (np.arange(HASHES)[None, :], rows), 1)
            common.append(counts.argmax(axis=1).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(common, pa.binary())], names=["band", "common"])


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            mine, common = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(-1, HASHES) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array((mine == common).sum(axis=1))], names=["band", "sid", "agree"])


def _sets_of(wanted: DataFrame, documents: DataFrame) -> DataFrame:
    """(sid, tokens) of the sets named in ``wanted`` (sid), from their texts, which are read again."""
    texts = rows_times(documents.select("row_id", "text"), wanted.select(F.col("sid").alias("row_id"), F.lit(1).alias("copies")))
    return checkpointed(texts.mapInArrow(_token_rows, "sid bigint, tokens binary"))


def _confirmed(pairs: DataFrame, sets: DataFrame, documents: DataFrame) -> DataFrame:
    """Links (a, b) among the pairs (hub, sid): by size and signature first, then by the whole sets."""
    signed = sets.select("sid", "n", "signature")
    of_hub = signed.select(F.col("sid").alias("hub"), F.col("n").alias("hub_n"), F.col("signature").alias("hub_signature"))
    with_member = checkpointed(join_unique(checkpointed(pairs), signed, "sid"))
    alike = checkpointed(
        join_unique(with_member, of_hub, "hub").select("hub", "sid", "n", "hub_n", "signature", "hub_signature")
        .mapInArrow(_alike, "hub bigint, sid bigint")
    )
    tokens = _sets_of(alike.select("sid").unionByName(alike.select(F.col("hub").alias("sid"))).distinct(), documents)
    lots = checkpointed(alike.groupBy("hub").agg(F.ceil(F.count("*") / PER_HUB).alias("lots")))
    dealt = checkpointed(join_unique(alike, lots, "hub").withColumn("lot", F.pmod(F.xxhash64("sid"), "lots")))
    members = join_unique(dealt, tokens, "sid").select("hub", "lot", F.col("sid").alias("member"), "tokens")
    hubs = lots.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("lots") - 1))).join(
        tokens, F.col("hub") == F.col("sid")
    ).select("hub", "lot", F.lit(None).cast("bigint").alias("member"), "tokens")
    rows = hubs.unionByName(members).repartition("hub", "lot").sortWithinPartitions("hub", "lot", F.col("member").asc_nulls_first())
    return rows.mapInArrow(_linked, "a bigint, b bigint")


def _apart(shared: DataFrame, components: DataFrame) -> DataFrame:
    """Rows (band, sid, part, many) of the bands whose sets lie in several components so far."""
    named = components.select(F.col("node").alias("sid"), "component")
    placed = checkpointed(join_unique(shared, named, "sid", "left").select("band", "sid", F.coalesce("component", "sid").alias("part")))
    open_ = placed.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("many")).filter("low <> high")
    return checkpointed(join_unique(placed, open_.select("band", "many"), "band"))


def _meetings(open_: DataFrame, hubs: DataFrame) -> DataFrame:
    """Pairs (hub, sid): the sets of a band and its hubs (band, hubs: part and sid) in other components."""
    met = join_unique(open_, checkpointed(hubs), "band").select("sid", "part", F.explode(F.array_distinct("hubs")).alias("hub"))
    return met.filter(F.col("part") != F.col("hub.part")).select(F.col("hub.sid").alias("hub"), "sid").distinct()


def _most_common(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """The members of each band that agree most with what is common in it."""
    signed = sets.select("sid", "signature")
    some = Window.partitionBy("band").orderBy(F.xxhash64("sid"), "sid")
    # cut off before the shuffle as well, so a band is never in one task
    sample = checkpointed(open_.select("band", "sid").withColumn("nth", F.row_number().over(some)).filter(F.col("nth") <= COMMON).drop("nth"))
    common = join_unique(sample, signed, "sid").groupBy("band").agg(F.collect_list("signature").alias("prints"))
    common = checkpointed(common.mapInArrow(_common, "band bigint, common binary"))
    with_print = checkpointed(join_unique(open_.select("band", "sid"), signed, "sid"))
    agreed = join_unique(with_print, common, "band").select("band", "sid", "signature", "common").mapInArrow(_agreement, "band bigint, sid bigint, agree bigint")
    most = Window.partitionBy("band").orderBy(F.desc("agree"), "sid")
    best = checkpointed(agreed.withColumn("nth", F.row_number().over(most)).filter(F.col("nth") <= MEET))
    parts = open_.select("sid", "part").distinct()
    return best.join(parts, "sid").groupBy("band").agg(F.collect_list(F.struct("part", "sid")).alias("hubs"))


def _rest(open_: DataFrame, sets: DataFrame, documents: DataFrame) -> DataFrame:
    """Links (a, b) of what lies outside the main component of a band with all of the band."""
    counts = open_.groupBy("band", "part").agg(F.count("*").alias("n"))
    main = checkpointed(counts.groupBy("band").agg(F.max(F.struct("n", F.col("part").alias("part"))).alias("main")).select("band", F.col("main.part").alias("main")))
    rows = checkpointed(join_unique(open_, main, "band").select("band", "sid", "part", (F.col("part") == F.col("main")).alias("main")))
    tokens = _sets_of(rows.select("sid").distinct(), documents)
    weight = tokens.select("sid", F.octet_length("tokens").alias("bytes"))
    sized = checkpointed(join_unique(rows, weight, "sid"))
    cut = lambda size: F.greatest(F.lit(1), F.ceil(size / BLOCK_BYTES)).cast("int")
    cuts = checkpointed(sized.groupBy("band").agg(
        cut(F.sum("bytes")).alias("all"), cut(F.sum(F.when(~F.col("main"), F.col("bytes")).otherwise(0))).alias("few")
    ))
    dealt = checkpointed(join_unique(sized.drop("bytes"), cuts, "band"))
    every = lambda n: F.explode(F.expr(f"sequence(0, {n} - 1)"))
    own = lambda n: F.pmod(F.xxhash64("sid"), F.col(n)).cast("int")
    names = ["band", "low", "high", "asks", "sid", "part", "main"]
    asking = dealt.filter("NOT main").select("*", F.lit(True).alias("asks"), own("few").alias("low"), every("all").alias("high")).select(*names)
    asked = dealt.select("*", F.lit(False).alias("asks"), own("all").alias("high"), every("few").alias("low")).select(*names)
    whole = sets.select("sid", "signature", "bands").join(tokens, "sid")
    both = join_unique(checkpointed(asking.unionByName(asked)), whole, "sid").select(*names, "signature", "bands", "tokens")
    # tasks are small in rows but heavy in work
    parts = parts_for(open_.sparkSession, 1, 1)
    return both.repartition(parts, "band", "low", "high").sortWithinPartitions("band", "low", "high", F.desc("asks")).mapInArrow(_across, "a bigint, b bigint")


def _components(sets: DataFrame, documents: DataFrame) -> DataFrame:
    """(node, component) of the sets that have links."""
    listed = checkpointed(sets.select("sid", F.explode("bands").alias("band")))
    buckets = checkpointed(listed.groupBy("band").agg(F.count("*").alias("many"), F.min("sid").alias("hub")).filter("many > 1"))
    shared = checkpointed(join_unique(listed, buckets, "band").select("band", "sid", "hub", "many"))
    links = checkpointed(_confirmed(shared.filter("sid <> hub").select("hub", "sid").distinct(), sets, documents))
    components = connected_components(links)
    open_ = _apart(shared.filter("many > 2").select("band", "sid"), components)  # bands of two are settled
    if open_.isEmpty():
        return components
    found = checkpointed(_confirmed(_meetings(open_, _most_common(open_, sets)), sets, documents))
    links = checkpointed(links.unionByName(found))
    components = connected_components(links)
    open_ = _apart(open_.select("band", "sid"), components)
    if open_.isEmpty():
        return components
    found = checkpointed(_rest(open_, sets, documents))
    return components if found.isEmpty() else connected_components(links.unionByName(found))


def minhash_duplicates(docs: DataFrame) -> DataFrame:
    """Every row as ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest ``doc_id`` that links lead to, the row itself
    included, and ``kept`` says whether that is the row's own id. Null text is
    empty; texts without words link with nothing and are kept. Null ids never name
    a component unless all of it is null. Rows that repeat as a whole fall into
    one class and share ``kept``. Columns other than ``doc_id`` and ``text`` play
    no part; an empty table gives an empty result. Texts of any length count whole;
    a task holds one set at a time, or where bands stay apart sets of 64 MB.
    """
    spark = docs.sparkSession
    with scratch(spark) as keep:
        documents = numbered_documents(docs).select("doc.doc_id", "row_id", whole_text("doc.text").alias("text"))
        id_type = documents.schema["doc_id"].dataType.simpleString()
        scan = checkpointed(documents.select("doc_id", "row_id", "text").mapInArrow(
            _signed, f"doc_id {id_type}, row_id bigint, digest binary, n bigint, signature binary, bands array<bigint>"
        ))
        sets = checkpointed(
            scan.filter("signature IS NOT NULL").dropDuplicates(["digest"])
            .select("digest", F.col("row_id").alias("sid"), "n", "signature", "bands")
        )
        components = _components(sets, documents)
        placed = sets.select("digest", "sid").join(components, F.col("sid") == F.col("node"), "left").select(
            "digest", F.coalesce("component", "sid").alias("component")
        )
        rows = scan.select("doc_id", "digest", "n")
        first = rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first"))
        classes = checkpointed(placed.join(first, "digest"))
        names = classes.groupBy("component").agg(F.min("first").alias("component_id"))
        named = checkpointed(join_unique(classes, names, "component").select("digest", "component_id"))
        out = keep(join_unique(checkpointed(rows), named, "digest", "left").select(
            "doc_id", F.col("n").alias("n_shingles"),
            F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        ))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
