"""A manifest of a dataset as a hash tree, with a proof for every row.

Each row is a leaf; the leaves of a language, by ``doc_id``, make a tree of fan-out
8, and the roots of the languages make one more above them. Only every third level
is stored. A stored node covers an aligned subtree of up to 512 nodes of the level
stored below it, and a proof regenerates the two levels between from those, takes
the siblings and drops the rest.

Proofs are made from the top down: a stored node gets the siblings on its way to
the root once, and its subtree inherits them. Whatever is done in one place is done
to one subtree, so a language that holds most rows is spread like many small ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aidmatch.llm.common import saved_with_row_id
from aidmatch.workspace import checkpointed, scratch

FAN = 8
#: Levels from one that is stored to the next.
STORED_EVERY = 3
SUBTREE = FAN**STORED_EVERY
#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows that go to one batch of results.
BATCH = 4096


def digest(nodes: list[bytes]) -> bytes:
    """H of digests: SHA-256 of their lowercase hex texts in a row."""
    return hashlib.sha256("".join(n.hex() for n in nodes).encode()).digest()


def levels_of(nodes: list[bytes], whole_tree: bool) -> list[list[bytes]]:
    """A stored subtree level by level: up to the one node of a tree that ends here, else as far as is stored next."""
    levels = [nodes]
    while len(levels[-1]) > 1 if whole_tree else len(levels) <= STORED_EVERY:
        last = levels[-1]
        levels.append([digest(last[i:i + FAN]) for i in range(0, len(last), FAN)])
    return levels


def siblings(levels: list[list[bytes]], at: int) -> tuple[bytes, bytes]:
    """For the node ``at`` of the lowest level: a byte for each level, left siblings * 8 + right ones, and all siblings from there up."""
    turns, found = bytearray(), []
    for level in levels[:-1]:
        first = at - at % FAN
        run = level[first:first + FAN]
        left, right = run[:at - first], run[at - first + 1:]
        turns.append(len(left) * FAN + len(right))
        found += left + right
        at //= FAN
    return bytes(turns), b"".join(found)


def fold(node: bytes, turns: bytes, found: bytes) -> bytes:
    """The root that a node and the siblings on its way up give."""
    at = 0
    for turn in turns:
        left, right = divmod(turn, FAN)
        sides = [found[i:i + 32] for i in range(at, at + 32 * (left + right), 32)]
        node = digest([*sides[:left], node, *sides[left:]])
        at += 32 * (left + right)
    return node


def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """The digest of a row; ``text`` stands in for its own text."""
    fields = [_encoded(F.col(f) if f != "text" or text is None else text) for f in FIELDS]
    return F.unhex(F.sha2(F.concat(*fields), 256))


def _tree(lang: Column) -> Column:
    """A key of a language that sorts as languages do, null first."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def _positions(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``pos`` within ``tree`` and ``total``, its number of rows. A sort over the cluster; only counts per task are added up."""
    placed = saved_with_row_id(rows.sort("tree", *order))
    part = F.shiftright("row_id", 36).alias("part")
    parts = checkpointed(placed.groupBy("tree", part).agg(F.min("row_id").alias("first"), F.count("*").alias("many")))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = checkpointed(parts.select(
        "tree", "part", (F.coalesce(F.sum("many").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("many").over(Window.partitionBy("tree")).alias("total"),
    ))
    return checkpointed(
        placed.withColumn("part", part).join(starts, ["tree", "part"])
        .withColumn("pos", F.col("row_id") + F.col("shift")).drop("part", "row_id", "shift")
    )


def _subtrees(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """((tree, block), rows) of each subtree from rows that come sorted by their first two columns; no more than one is held."""
    key, rows = None, []
    for batch in batches:
        values = [batch.column(i).to_pylist() for i in range(columns)]
        for row in zip(*values):
            if row[:2] != key:
                if rows:
                    yield key, rows
                key, rows = row[:2], []
            rows.append(row[2:])
    if rows:
        yield key, rows


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


_NODE = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("node", pa.binary()), ("total", pa.int64())])


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for (tree, block), nodes in _subtrees(batches, 5):
            total = nodes[0][2]
            top = levels_of([n[1] for n in nodes], total <= SUBTREE)[-1]
            yield tree, block, top[0], -(-total // SUBTREE)

    return _batches(rows(), _NODE)


def _in_subtrees(nodes: DataFrame, *columns: str) -> DataFrame:
    block = F.shiftright("pos", STORED_EVERY * (FAN.bit_length() - 1)).alias("block")
    return nodes.select("tree", block, "pos", *columns)


def _stored_levels(lowest: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels of all trees, from nodes (tree, pos, node, total), and the roots (tree, node)."""
    stored, roots = [], None
    now = lowest
    while True:
        stored.append(now)
        rows = _in_subtrees(now, "node", "total").repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
        above = checkpointed(rows.mapInArrow(_tops, "tree string, pos bigint, node binary, total bigint"))
        done = above.filter("total = 1").select("tree", "node")
        roots = done if roots is None else roots.unionByName(done)
        now = above.filter("total > 1")
        if now.isEmpty():
            return stored, checkpointed(roots)


_WAY = "turns binary, siblings binary, subroot binary, root binary"


def _with_ways(stored: DataFrame, above: DataFrame, carried: list[str], make, schema: str) -> DataFrame:
    """Run ``make`` over every subtree of a stored level, its top's way up (``above``: tree, block, way) first."""
    head = above.select("tree", "block", F.lit(-1).cast("bigint").alias("pos"), "turns", "siblings", "subroot", "root")
    rows = _in_subtrees(stored, "total", "node", *carried)
    both = head.unionByName(rows, allowMissingColumns=True).select(
        "tree", "block", "pos", "turns", "siblings", "subroot", "root", "total", "node", *carried
    )
    return both.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos").mapInArrow(make, schema)


def _ways(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[tuple, tuple, bytes, bytes, bytes, bytes]]:
    """For each node of each subtree: (tree, pos), its row, the turns and siblings of its whole way, subroot and root."""
    for (tree, _), (head, *nodes) in _subtrees(batches, columns):
        _, turns, found, subroot, root = head[:5]
        levels = levels_of([n[6] for n in nodes], nodes[0][5] <= SUBTREE)
        for at, node in enumerate(nodes):
            own_turns, own = siblings(levels, at)
            yield (tree, node[0]), node, own_turns + turns, own + found, subroot, root


_WAY_ROW = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("turns", pa.binary()), ("siblings", pa.binary()), ("subroot", pa.binary()), ("root", pa.binary())])


def _node_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _batches(
        ((tree, pos, turns, found, subroot, root) for (tree, pos), _, turns, found, subroot, root in _ways(batches, 9)), _WAY_ROW
    )


def _ways_down(stored: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The ways (tree, block, ...) of the tops of the lowest subtrees, from the ways of the roots, one stored level after the other."""
    above = tops
    for level in reversed(stored[1:]):
        # only trees that reach as high have nodes here; the others' ways go down as they are
        made = _with_ways(level, above.join(level.select("tree").distinct(), "tree", "left_semi"), [], _node_ways, f"tree string, block bigint, {_WAY}")
        above = checkpointed(above.join(level.select("tree").distinct(), "tree", "left_anti").unionByName(made))
    return above


_PROOF = pa.schema([
    ("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()),
    ("folded_root", pa.string()), ("verified", pa.bool_()),
])


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for _, node, turns, found, subroot, root in _ways(batches, 11):
            own, doc_id, seen = node[6:9]
            folded = fold(seen if seen is not None else own, turns, found)
            yield doc_id, own.hex(), subroot.hex(), root.hex(), hashlib.sha256(found.hex().encode()).hexdigest(), folded.hex(), folded == root

    return _batches(rows(), _PROOF)


def manifest(docs: DataFrame, seen_leaf: Column | None = None) -> DataFrame:
    """Every row as ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``docs`` has ``doc_id, source, lang, n_chars, text``, each of which may be
    null; other columns play no part. ``seen_leaf`` is the leaf of the row as a
    reader finds it, null where that is the row as it was; ``folded_root`` and
    ``verified`` tell whether the reader's row and the proof lead to the root. Null
    ids come first in a language, and rows of one id by their leaves, so identical
    rows have equal leaves and places of their own. A text is whole whatever its
    length. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    seen = F.lit(None).cast("binary") if seen_leaf is None else seen_leaf
    with scratch(spark) as keep:
        # digests are made once: the sort below reads its input twice
        leaves = checkpointed(docs.select(
            _tree(F.col("lang")).alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf().alias("node"), seen.alias("seen")
        ))
        placed = _positions(leaves, [F.col("doc_id").asc_nulls_first(), F.col("node")])
        stored, subroots = _stored_levels(placed.select("tree", "pos", "node", "total"))
        # the roots of the languages are the leaves of one more tree
        langs = _positions(
            subroots.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "node"), [F.col("lang")]
        )
        upper, root = _stored_levels(langs.select("tree", "pos", "node", "total"))
        empty = F.lit(b"")
        top = root.select(
            "tree", F.lit(0).cast("bigint").alias("block"), empty.alias("turns"), empty.alias("siblings"), F.col("node").alias("subroot"), F.col("node").alias("root")
        )
        above = _with_ways(langs, _ways_down(upper, top), [], _node_ways, f"tree string, block bigint, {_WAY}").withColumnRenamed("block", "pos")
        tops = checkpointed(
            langs.select(F.col("lang").alias("tree"), "pos", F.col("node").alias("subroot"))
            .join(above.select("pos", "turns", "siblings", "root"), "pos")
            .select("tree", F.lit(0).cast("bigint").alias("block"), "turns", "siblings", "subroot", "root")
        )
        found = _with_ways(placed, _ways_down(stored, tops), ["doc_id", "seen"], _proofs,
                           "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
        return keep(found)


def tampered_text() -> Column:
    """The text with A-Z as lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate("text", upper, upper.lower())


def audited(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` checked against rows of which those with 3 dividing the crc32 of their id have their text in lower case."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return manifest(docs, F.when(hit, leaf(tampered_text())))


def _sql(levels: int = 7, upper: int = 3) -> str:
    """The same in DuckDB's SQL, for up to 8 ** levels rows of a language and 8 ** upper languages."""
    fields = lambda text: " || ".join(
        f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in ("doc_id", "source", "lang", "n_chars", text)
    )
    parts = [f"""crcs AS (
  SELECT doc_id, xor(4294967295::UBIGINT, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT),
         lambda crc, byte: list_reduce(list_transform([0, 1, 2, 3, 4, 5, 6, 7], lambda i: i::UBIGINT),
           lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END, xor(crc, byte)), 4294967295::UBIGINT)) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents)),
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({fields('text')}) AS leaf,
         CASE WHEN crc % 3 = 0 THEN sha256({fields("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS seen
  FROM documents LEFT JOIN crcs USING (doc_id)),
rows_ AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
a0 AS (SELECT tree, pos, leaf AS node, n FROM rows_)"""]

    def climb(name: str, height: int):
        for k in range(height):
            parts.append(f"""{name}g{k} AS (SELECT tree, pos // 8 AS pos, n, list(node ORDER BY pos) AS nodes FROM {name}{k} GROUP BY ALL),
{name}{k + 1} AS (SELECT tree, pos, CASE WHEN n = 1 THEN nodes[1] ELSE sha256(array_to_string(nodes, '')) END AS node, (n + 7) // 8 AS n FROM {name}g{k})""")

    climb("a", levels)
    parts.append(f"langs AS (SELECT tree AS lang, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, node, count(*) OVER () AS n FROM a{levels})")
    parts.append("b0 AS (SELECT tree, pos, node, n FROM langs)")
    climb("b", upper)
    parts.append("w0 AS (SELECT r.*, l.pos AS nth, l.node AS subroot, '' AS proof, coalesce(r.seen, r.leaf) AS folded FROM rows_ r JOIN langs l ON r.tree = l.lang)")
    at = 0
    for name, height, tree, place in (("a", levels, "w.tree", "w.pos"), ("b", upper, "''", "w.nth")):
        for k in range(height):
            mine = f"({place} // {8**k})"
            parts.append(f"""w{at + 1} AS (
  SELECT w.* REPLACE (CASE WHEN g.n = 1 THEN proof ELSE proof || left_ || right_ END AS proof,
                      CASE WHEN g.n = 1 THEN folded ELSE sha256(left_ || folded || right_) END AS folded)
  FROM w{at} w JOIN (SELECT *, pos AS run FROM {name}g{k}) g ON g.tree = {tree} AND g.run = {place} // {8**(k + 1)},
       LATERAL (SELECT array_to_string(nodes[1:{mine} % 8], '') AS left_, array_to_string(nodes[{mine} % 8 + 2:], '') AS right_))""")
            at += 1
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, b{upper}.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = b{upper}.node AS verified
FROM w{at} CROSS JOIN b{upper}"""


MANIFEST_SQL = _sql()
