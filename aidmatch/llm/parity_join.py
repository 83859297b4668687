"""Near duplicates by a parity-sketch join of shingle sets.

Tokens of a set are hashed into parts, and a part's sketch is the XOR of its
token hashes. A token in only one of two sets changes the parity of one part, so
sets that differ in D tokens agree in all parts but D at most. Let every set
list its non-empty parts in one global order (parts of many tokens first) and
keep the first D + 1: two sets within D of each other share one of the listed
sketches. (Before the first part in common, each lists only parts that differ,
D at most.) Sets of one class of sizes use the same parts, a set that can reach
the next class lists its parts for that class too. Sizes bound D, since
Jaccard >= 0.8 means |A ^ B| <= (|A| + |B|) / 9.

Sets that share a listed sketch are candidates. Their whole bit sketches are
compared first, the Hamming distance being a lower bound of the difference, and
then the sets themselves. Within a group of sets that share a sketch no pairs
are listed until they are needed. Every set is compared with the first of a group,
then, as long as that joins components, with a few random members of the largest
component that meets it. Only groups that still fall into several components are
searched for all pairs across components. A group of more than ``LARGE`` sets, such
as those that share one passage, is parted first: its sets list again with the
sketches of large groups last in the order, so that they meet by what few others
have. The order is still one for all, so linked sets still meet. Groups that stay
large, of sets that have hardly anything else, are dealt out as pairs of blocks. No
link that could join two components is lost.

Rows are single sets and sketches, groups stream through sorted partitions, and
equal sets count as one. A set of n tokens lists about n / 4 parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidmatch.llm.common import numbered_documents, rows_times, whole_text
from aidmatch.llm.components import connected_components
from aidmatch.llm.shingles import mix, shingle_set
from aidmatch.workspace import checkpointed, scratch

#: Two sets link when 100 * |A & B| >= 80 * |A | B|; the bounds below follow from this.
PERCENT = 80
#: Sizes from which the classes of sizes begin. In the first, every token is a part of its own.
CLASSES = [4, *(64 * 4**k for k in range(20))]
#: Tokens of the smallest set of a class for each part: enough parts stay non-empty (README) and most listed ones hold several.
TOKENS_PER_PART = 0.75
#: A task lists the parts of equal sets once as long as it remembers them.
REMEMBERED = 200_000
#: Sets are sent out in a broadcast only up to so many ids; beyond, by a shuffle of the texts.
BROADCAST_IDS = 4_000_000
#: Sets compared with one hub in one task.
PER_HUB = 4096
#: Random members of the largest component around that a set is compared with in one turn.
MEET = 8
#: Sets of a group that one task compares pair by pair, and of a block of a larger group.
LARGE, BLOCK = 8192, 4096
BLOCK_BYTES = 1 << 25

_U = np.uint64


def most_different(size: int, limit: int | None = None) -> int:
    """How many tokens a set of this size and a linked larger one can differ in."""
    largest = size * 100 // PERCENT
    return (size + (largest if limit is None else min(largest, limit))) * (100 - PERCENT) // (100 + PERCENT)


def class_of(size: int) -> int:
    return int(np.searchsorted(CLASSES, size, side="right")) - 1


def set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def listed_parts(tokens: np.ndarray, last: np.ndarray | None = None) -> np.ndarray:
    """The sketches that a set lists, in its own class of sizes and in the next if it reaches that.

    The sketches in ``last``, sorted, come after all others in the order.
    Sets of fewer than 4 tokens link only with equal sets and list nothing.
    """
    size, found = len(tokens), []
    if size < CLASSES[0]:
        return np.empty(0, dtype=np.int64)
    own = class_of(size)
    for nth in range(own, class_of(size * 100 // PERCENT) + 1):
        keep = most_different(size, CLASSES[nth + 1] - 1) + 1
        seed = mix(np.array([nth + 1], dtype=np.uint64))[0]
        if nth == 0:
            sketches = tokens if last is not None else tokens[:keep]
        else:
            parts = _U(int(CLASSES[nth] / TOKENS_PER_PART))
            part = ((tokens >> _U(32)) * parts) >> _U(32)  # tokens are sorted, so parts are runs
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            counts = np.diff(np.r_[starts, size])
            sketches = np.bitwise_xor.reduceat(mix(tokens), starts)
            first = np.argsort(-counts, kind="stable")[:len(counts) if last is not None else keep]
            sketches = sketches[first] + part[starts[first]] * _U(0x9E3779B97F4A7C15)
        sketches = mix(sketches ^ seed).view(np.int64)
        if last is not None:
            at = np.searchsorted(last, sketches) % len(last)
            sketches = sketches[np.argsort(last[at] == sketches, kind="stable")[:keep]]
        found.append(sketches)
    return np.concatenate(found)


def bit_sketch(tokens: np.ndarray) -> bytes:
    """Parities of the tokens in a power of two of bits, by the largest class of sizes the set reaches."""
    reach = max(class_of(len(tokens) * 100 // PERCENT), 0)
    bits = 256 if reach == 0 else CLASSES[reach] * 8
    odd = np.bincount((tokens & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def fold(sketch: np.ndarray, width: int) -> np.ndarray:
    """A sketch of bytes as one of ``width`` bytes; parities of a narrower sketch are XORs of those of a wider one."""
    # bit = token mod bits, so the halves of the wider sketch meet
    return np.bitwise_xor.reduce(sketch.reshape(-1, width), axis=0)


def _sets(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
    for text in batch.column(column):
        yield shingle_set(text.as_py())


def set_rows(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` of every row with ``set_id`` (null for an empty set) and ``n_shingles``."""
    kinds = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = [], []
            for tokens in _sets(batch, len(keys)):
                ids.append(set_id(tokens) if len(tokens) else None)
                sizes.append(len(tokens))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keys)], pa.array(ids, pa.int64()), pa.array(sizes, pa.int64())],
                names=[*keys, "set_id", "n_shingles"],
            )

    return docs.select(*keys, whole_text().alias("text")).mapInArrow(run, f"{kinds}, set_id bigint, n_shingles bigint")


def _part_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for batch in batches:
        sketches, ids, sizes, held = [], [], [], 0
        for nth, tokens in enumerate(_sets(batch, 0)):
            found = listed_parts(tokens)
            if len(found):
                name = set_id(tokens)
                if name not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(name)
                    sketches.append(found)
                    ids.append(np.full(len(found), name))
                    sizes.append(np.full(len(found), len(tokens), dtype=np.int32))
                    held += len(found)
            if held > 200_000 or held and nth == batch.num_rows - 1:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (sketches, sizes, ids)], names=["sketch", "n", "set_id"]
                )
                sketches, ids, sizes, held = [], [], [], 0


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sketches that several sets list, each with the hub it is compared with first.

    Rows come sorted by (sketch, n, set_id). A hub serves until sets grow too
    large for it; then the next one takes over.
    """
    held, with_last, hub = None, False, (0, 0)
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [np.asarray(batch.column(i)) for i in range(3)]
        if held is not None:
            rows = [np.r_[a, b] for a, b in zip(held, rows)]
        sketch, n, name = rows
        new = np.r_[True, (sketch[1:] != sketch[:-1]) | (name[1:] != name[:-1])]
        sketch, n, name = sketch[new], n[new], name[new]
        same = np.r_[with_last, sketch[1:] == sketch[:-1]]
        kept = same | np.r_[same[1:], False]
        kept[-1] = False  # waits for what follows
        out = np.flatnonzero(kept)
        hubs = np.empty(len(out), dtype=np.int64)
        for at, i in enumerate(out.tolist()):
            if not same[i] or n[i] * PERCENT > hub[1] * 100:
                hub = (name[i], int(n[i]))
            hubs[at] = hub[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(sketch[out]), pa.array(n[out]), pa.array(name[out]), pa.array(hubs)], names=["sketch", "n", "set_id", "hub"]
        )
        held, with_last = [sketch[-1:], n[-1:], name[-1:]], bool(same[-1])
    if held is not None and with_last:
        last = hub[0] if int(held[1][0]) * PERCENT <= hub[1] * 100 else held[2][0]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x) for x in held), pa.array([last], pa.int64())], names=["sketch", "n", "set_id", "hub"]
        )


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a group in different components whose sizes and bit sketches allow a link; rows come sorted by group.

    A row has a side; of a pair of blocks (sides 0 and 1) only pairs across count, in a whole group or block the side is 2.
    """
    def pairs(rows):
        rows.sort(key=lambda r: r[0])
        sizes = np.array([r[0] for r in rows], dtype=np.int64)
        names, parts, sides = (np.array([r[i] for r in rows]) for i in (1, 2, 4))
        width = min(len(r[3]) for r in rows)
        bits = np.stack([fold(np.frombuffer(r[3], dtype=np.uint8), width) for r in rows]).view(np.uint64)
        at = 0
        while at < len(rows):
            # sizes rise, so partners of a row reach up to a size
            reach = np.searchsorted(sizes, sizes[at] * 100 // PERCENT, side="right")
            step = max(1, min(256, BLOCK_BYTES // (width * max(1, int(reach - at)))))
            end = min(at + step, len(rows))
            reach = int(np.searchsorted(sizes, sizes[end - 1] * 100 // PERCENT, side="right"))
            for low in range(at, reach, 4096):
                other = slice(low, min(low + 4096, reach))
                apart = np.bitwise_count(bits[at:end, None] ^ bits[None, other]).sum(axis=2, dtype=np.int64)
                both = sizes[at:end, None] + sizes[None, other]
                fit = (apart * (100 + PERCENT) <= both * (100 - PERCENT)) & (parts[at:end, None] != parts[None, other])
                fit &= (sides[at:end, None] != sides[None, other]) | (sides[at:end, None] == 2)
                fit &= np.arange(at, end)[:, None] < np.arange(other.start, other.stop)[None]
                i, j = np.nonzero(fit)
                if len(i):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[at + i]), pa.array(names[other.start + j])], names=["hub", "set_id"]
                    )
            at = end

    last, rows = None, []
    for batch in batches:
        group = batch.column(0).to_pylist()
        for key, *row in zip(group, *(batch.column(i).to_pylist() for i in range(1, 6))):
            if key != last:
                if len(rows) > 1:
                    yield from pairs(rows)
                last, rows = key, []
            rows.append(row)
    if len(rows) > 1:
        yield from pairs(rows)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Linked pairs; rows come sorted by (hub, lot), the hub's own set first."""
    hub, theirs = None, None
    for batch in batches:
        found = []
        for name, member, tokens in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
            mine = np.frombuffer(tokens, dtype=np.uint64)
            if member is None:
                hub, theirs = name, mine
                continue
            assert hub == name
            both = len(mine) + len(theirs) - len(np.union1d(mine, theirs))
            if 100 * both >= PERCENT * (len(mine) + len(theirs) - both):
                found.append((hub, member))
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"]
        )


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sizes and bit sketches allow a link."""
    for batch in batches:
        kept = []
        for row, (n, m, mine, theirs) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(2, 6)))):
            if min(n, m) * 100 >= max(n, m) * PERCENT:
                width = min(len(mine), len(theirs))
                mine, theirs = (fold(np.frombuffer(x, dtype=np.uint8), width).view(np.uint64) for x in (mine, theirs))
                if int(np.bitwise_count(mine ^ theirs).sum()) * (100 + PERCENT) <= (n + m) * (100 - PERCENT):
                    kept.append(row)
        yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (hub, set_id) that link. A hub's set goes to every lot of its pairs, a pair carries one set."""
    bits = sets.select("set_id", "n", "bits")
    hub = bits.select(F.col("set_id").alias("hub"), F.col("n").alias("hub_n"), F.col("bits").alias("hub_bits"))
    pairs = checkpointed(
        pairs.join(bits, "set_id").join(hub, "hub").select("hub", "set_id", "n", "hub_n", "bits", "hub_bits")
        .mapInArrow(_possible, "hub bigint, set_id bigint")
    )
    lots = pairs.groupBy("hub").agg(F.ceil(F.count("*") / PER_HUB).alias("lots"))
    dealt = pairs.join(lots, "hub").withColumn("lot", F.pmod(F.xxhash64("set_id"), "lots"))
    members = dealt.join(sets, "set_id").select("hub", "lot", F.col("set_id").alias("member"), "tokens")
    hubs = lots.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("lots") - 1))).join(
        sets, F.col("hub") == F.col("set_id")
    ).select("hub", "lot", F.lit(None).cast("bigint").alias("member"), "tokens")
    rows = hubs.unionByName(members).repartition("hub", "lot").sortWithinPartitions("hub", "lot", F.col("member").asc_nulls_first())
    return checkpointed(rows.mapInArrow(_verify, "a bigint, b bigint"))


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(set_id(t), len(t), t.tobytes(), bit_sketch(t)) for t in _sets(batch, 0) if len(t)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in found], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
            names=["set_id", "n", "tokens", "bits"],
        )


def _open(rows: DataFrame, components: DataFrame) -> DataFrame:
    """The rows (sketch, n, set_id) of groups that lie in several components, with the component as ``part`` and the group's size."""
    part = F.coalesce("component", "set_id")
    placed = rows.join(components, F.col("set_id") == F.col("node"), "left").select("sketch", "n", "set_id", part.alias("part"))
    apart = placed.groupBy("sketch").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("many")).filter("low <> high")
    return placed.join(apart.select("sketch", "many"), "sketch")


def _blocks(rows: DataFrame) -> DataFrame:
    """Large groups as (group, n, set_id, part, side): every pair of sets whose sizes allow a link is in one group of two blocks, or one."""
    # sizes of linked sets lie in one band or in two that follow each other
    banded = rows.withColumn("band", F.floor(F.log("n") / F.log(F.lit(100 / PERCENT + 0.01))).cast("bigint"))
    cuts = checkpointed(banded.groupBy("sketch", "band").agg(F.ceil(F.count("*") / BLOCK).cast("bigint").alias("cuts")))
    near = lambda name, away: F.broadcast(cuts.select("sketch", (F.col("band") + away).alias("band"), F.col("cuts").alias(name)))
    dealt = banded.join(near("own", 0), ["sketch", "band"])
    for name, away in (("above", -1), ("below", 1)):
        dealt = dealt.join(near(name, away), ["sketch", "band"], "left")
    dealt = dealt.withColumn("cut", F.pmod(F.xxhash64("set_id"), "own"))
    # band and cut of the pair's lower block, then of its upper, and the row's side
    pair = "named_struct('a', {}, 'b', {}, 'c', {}, 'd', {}, 'side', {})"
    to = lambda count, body: f"transform(filter(sequence(0L, coalesce({count}, 0L)), i -> i < coalesce({count}, 0L)), i -> {body})"
    met = dealt.withColumn("met", F.explode(F.expr("concat(" + ", ".join((
        to("own", pair.format("band", "least(i, cut)", "band", "greatest(i, cut)", "CASE WHEN i = cut THEN 2 WHEN cut < i THEN 0 ELSE 1 END")),
        to("above", pair.format("band", "cut", "band + 1", "i", "0")),
        to("below", pair.format("band - 1", "i", "band", "cut", "1")),
    )) + ")")))
    group = F.concat_ws(":", "sketch", "met.a", "met.b", "met.c", "met.d")
    return met.select(group.alias("group"), "n", "set_id", "part", F.col("met.side").alias("side"))


def groups_to_search(shared: DataFrame, sets: DataFrame, components: DataFrame) -> DataFrame:
    """(group, n, set_id, part, side) of bounded groups in which every link between components is found."""
    spark = shared.sparkSession
    whole = lambda rows: rows.select(F.col("sketch").cast("string").alias("group"), "n", "set_id", "part", F.lit(2).alias("side"))
    rows = checkpointed(_open(shared, components))
    found = whole(rows.filter(F.col("many") <= LARGE))
    last = np.empty(0, dtype=np.int64)
    while True:
        large = rows.filter(F.col("many") > LARGE)
        names = np.array([r.sketch for r in large.select("sketch").distinct().collect()], dtype=np.int64)
        if not len(names):
            return found
        if np.isin(names, last).all():
            return found.unionByName(_blocks(large))
        last = np.union1d(last, names)
        order = spark.sparkContext.broadcast(last)

        def list_again(batches: Iterator[pa.RecordBatch], order=order) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                listed = [listed_parts(np.frombuffer(t, dtype=np.uint64), order.value) for t in batch.column(2).to_pylist()]
                if listed:
                    at = np.repeat(np.arange(len(listed)), [len(x) for x in listed])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(listed)), batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))],
                        names=["sketch", "n", "set_id"],
                    )

        again = sets.join(large.select("set_id").distinct(), "set_id", "left_semi").select("n", "set_id", "tokens")
        listed = again.mapInArrow(list_again, "sketch bigint, n bigint, set_id bigint").distinct()
        rows = checkpointed(_open(listed, components))
        found = found.unionByName(whole(rows.filter(F.col("many") <= LARGE)))


def link_sets(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, component) of the sets that have links; ``rows`` (doc_id, set_id, n_shingles) belong to ``docs``."""
    spark = docs.sparkSession
    text = docs.select(whole_text().alias("text"))
    listed = text.mapInArrow(_part_rows, "sketch bigint, n int, set_id bigint")
    shared = checkpointed(
        listed.repartition("sketch").sortWithinPartitions("sketch", "n", "set_id")
        .mapInArrow(_shared, "sketch bigint, n int, set_id bigint, hub bigint")
    )
    stars = checkpointed(shared.filter("hub <> set_id").select("hub", "set_id").distinct())

    # the texts of the candidates are read again: one document of each set
    wanted = checkpointed(
        shared.select("set_id").distinct().join(rows, "set_id").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
        .select("doc_id").distinct()
    )
    ids = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    # no id leads to the rows without one, so all of them are read
    chosen = docs.join(ids, "doc_id", "left_semi").unionByName(docs.filter("doc_id IS NULL")).select(whole_text().alias("text"))
    known = chosen.mapInArrow(_tokens, "set_id bigint, n bigint, tokens binary, bits binary").dropDuplicates(["set_id"])
    sets = checkpointed(known)

    def parted(pairs: DataFrame, components: DataFrame) -> DataFrame:
        """The pairs whose ends are in different components so far."""
        of = lambda side: components.select(F.col("node").alias(side), F.col("component").alias(f"{side}_in"))
        both = pairs.join(of("hub"), "hub", "left").join(of("set_id"), "set_id", "left")
        return both.filter("NOT coalesce(hub_in = set_id_in, false)").select("hub", "set_id")

    # one hub for each set, then the other hubs of sets that are still apart
    first = checkpointed(stars.groupBy("set_id").agg(F.min("hub").alias("hub")))
    links = _links(first, sets)
    components = connected_components(links)
    more = _links(parted(stars.join(first, ["hub", "set_id"], "left_anti"), components), sets)
    links = checkpointed(links.unionByName(more))
    components = connected_components(links)

    # groups of two are settled; sets of the others meet a random member of the largest component around
    groups = checkpointed(shared.groupBy("sketch").agg(F.count("*").alias("many")).filter("many > 2").select("sketch"))
    shared = checkpointed(shared.join(groups, "sketch").select("sketch", "n", "set_id"))
    turn = 0
    while True:
        turn += 1
        part = F.coalesce("component", "set_id")
        placed = shared.join(components, F.col("set_id") == F.col("node"), "left").select("sketch", "n", "set_id", part.alias("part"))
        apart = placed.groupBy("sketch").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high")
        # groups that have come together are done
        shared = checkpointed(placed.join(apart.select("sketch"), "sketch"))
        large = components.groupBy("component").agg(F.count("*").alias("size"))
        ranked = shared.join(large, F.col("part") == F.col("component"), "left").withColumn("by_size", F.coalesce(-F.col("size"), F.lit(-1)))
        hubs = ranked.groupBy("sketch").agg(*(
            F.min(F.struct("by_size", "part", F.xxhash64("set_id", F.lit(turn), F.lit(i)), "set_id")).alias(f"hub{i}")
            for i in range(MEET)
        ))
        met = shared.join(hubs, "sketch").groupBy("set_id").agg(F.array(*(
            F.min(F.when(F.col("part") != F.col(f"hub{i}.part"), F.col(f"hub{i}"))) for i in range(MEET)
        )).alias("hubs")).select("set_id", F.explode("hubs").alias("hub")).select(F.col("hub.set_id").alias("hub"), "set_id")
        shared = shared.drop("part")
        more = _links(checkpointed(met.filter("hub IS NOT NULL").distinct()), sets)
        found = more.count()
        if found:
            links = checkpointed(links.unionByName(more))
            components = connected_components(links)
        if found * 10 <= links.count():
            break

    # what remains: any two sets of a group that lie in different components
    open_ = groups_to_search(shared, sets, components).join(sets.select("set_id", "bits"), "set_id").select(
        "group", "n", "set_id", "part", "bits", "side"
    )
    near = checkpointed(
        open_.repartition("group").sortWithinPartitions("group").mapInArrow(_near, "hub bigint, set_id bigint").distinct()
    )
    if near.isEmpty():
        return components
    more = _links(near, sets)
    return connected_components(links.unionByName(more))


def near_duplicates(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row as ``keys, set_id, n_shingles, component_id``.

    ``component_id`` is the smallest ``doc_id`` that links lead to, the row
    itself included; rows without words link with nothing. Null text is empty,
    null ids never name a component unless all of it is null, identical rows
    fall into one class. An empty table gives an empty result.
    """
    rows = checkpointed(set_rows(docs, list(keys)))
    components = link_sets(docs, rows)
    classes = rows.filter("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("first"))
    placed = classes.join(components, F.col("set_id") == F.col("node"), "left").select(
        "set_id", "first", F.coalesce("component", "set_id").alias("component")
    )
    names = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = placed.join(names, "component").select("set_id", "component_id")
    return rows.join(named, "set_id", "left").select(
        *keys, "set_id", "n_shingles", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, its smallest id; all columns as they were."""
    rows = numbered_documents(docs)
    with scratch(docs.sparkSession) as keep:
        found = near_duplicates(rows.select("doc.doc_id", "doc.text", "row_id"), ("doc_id", "row_id"))
        group = F.coalesce(F.col("component_id").cast("string"), F.lit("-"))
        alone = F.when(F.col("set_id").isNull() | F.col("component_id").isNull(), F.col("row_id"))
        kept = keep(found.groupBy(group.alias("group"), alone.alias("alone")).agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_id")).alias("first")
        ).select("first.row_id", F.lit(1).alias("copies")))
    return rows_times(rows, kept).select("doc.*")
