"""Phrases that stand out, by relational mining of occurrences (SETM).

A relation R_k holds every occurrence of a frequent phrase of k words: by phrase and chunk, its
sorted positions; a chunk is a bounded run of pieces of one language, and positions leave a gap
where a piece ends. R_k and R_k are merged in the order of their positions: two phrases at adjacent
positions of a piece make one of k + 1 words. The result is dealt out by phrase, the groups are
counted, and occurrences of those that are frequent go on as R_(k+1).

The phrases of a chunk that fall into one bucket travel in one row, as packed numbers. Merging needs
one chunk at a time and counting one bucket at a time; both are of bounded size, but for the positions of
very frequent phrases, a byte or two each, which pass through their bucket unread. What is not frequent is
never written to a table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aidmatch.llm.common import whole_text
from aidmatch.workspace import checkpointed, discard, scratch

#: Words of the longest phrase, and the least number of its occurrences.
LONGEST, FREQUENT = 4, 30
SCALE = 2_000_000
#: A phrase goes when a longer one around it has this share of its occurrences, in percent.
COVERED = 80
BEST = 2000
#: Bytes of text that make a chunk; a chunk ends with a piece.
CHUNK = 1 << 22
#: Bytes of text for which there is a bucket, each about a fifth of so many occurrences.
BUCKET = 1 << 22
#: Names of frequent groups that are sent out to longer ones, about 80 bytes each; both are shuffled beyond.
BROADCAST_GROUPS = 100_000
#: Rows of one batch that leaves a task.
BATCH = 50_000

_WORD, _GAP, _END = 0, 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = _GAP
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _END


def _chunks(texts: list[bytes]) -> Iterator[bytes]:
    """Texts in runs of about CHUNK bytes; a long text is cut, but only where a piece ends."""
    held, size = [], 0
    for text in texts:
        at = 0
        while len(text) - at > CHUNK:
            window = _KIND[np.frombuffer(text, dtype=np.uint8, offset=at + CHUNK)]
            ends = np.flatnonzero(window == _END)
            if not len(ends):
                break
            end = at + CHUNK + int(ends[0])
            yield text[at:end]
            at = end
        held.append(text[at:])
        size += len(text) - at
        if size >= CHUNK:
            yield b"\n".join(held)
            held, size = [], 0
    if held:
        yield b"\n".join(held)


def words_at(chunk: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of a chunk in order, and their positions: one apart within a piece, two or more from piece to piece."""
    raw = np.frombuffer(chunk, dtype=np.uint8)
    kind = _KIND[raw]
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = kind == _WORD
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    pieces = np.cumsum(kind == _END)[starts] if len(starts) else starts
    at = np.arange(len(starts)) + np.cumsum(np.diff(pieces, prepend=pieces[:1]) > 0)
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    letters = raw[kind == _WORD]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words, at.astype(np.int32)


def pack(at: np.ndarray, first: np.ndarray) -> pa.Array:
    """Lists of rising positions, of which those at ``first`` begin one, as differences of seven bits to a byte."""
    if not len(at):
        return pa.array([b""] * len(first), pa.binary())
    step = np.diff(at.astype(np.int64), prepend=0)
    step[first] = at[first]
    size = 1 + sum((step >= 1 << bits).astype(np.int64) for bits in (7, 14, 21, 28))
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]), dtype=np.uint8)
    for i in range(int(size.max())):
        rows = np.flatnonzero(size > i)
        out[ends[rows] - size[rows] + i] = (step[rows] >> (7 * i) & 127) | np.where(size[rows] > i + 1, 128, 0)
    offsets = np.r_[(ends - size)[first], ends[-1]].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def unpack(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The positions of all lists in a row, and how many there are in each."""
    offsets = np.frombuffer(lists.buffers()[1], dtype=np.int32)[lists.offset:lists.offset + len(lists) + 1]
    data = np.frombuffer(lists.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    ends = np.flatnonzero(data < 128)
    starts = np.r_[0, ends[:-1] + 1][:len(ends)]
    size = ends - starts + 1
    step = np.zeros(len(ends), dtype=np.int64)
    for i in range(int(size.max(initial=0))):
        rows = np.flatnonzero(size > i)
        step[rows] |= (data[starts[rows] + i] & 127).astype(np.int64) << (7 * i)
    first = np.searchsorted(ends, offsets - offsets[0])
    counts = np.diff(first)
    sums = np.r_[0, np.cumsum(step)]
    return sums[1:] - np.repeat(sums[first[:-1]], counts), counts


def _planes(numbers: np.ndarray, rising: bool = False) -> bytes:
    """Numbers, rising ones as their differences, with their lowest bytes first, then the next: what is small compresses well."""
    numbers = np.diff(numbers, prepend=0) if rising else numbers
    return numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(planes: bytes, rising: bool = False) -> np.ndarray:
    numbers = np.frombuffer(planes, dtype=np.uint8).reshape(8, -1).T.copy().view("<i8").ravel()
    return np.cumsum(numbers) if rising else numbers


def _run(lists: pa.Array) -> bytes:
    """Packed lists without the bounds between them."""
    offsets = np.frombuffer(lists.buffers()[1], dtype=np.int32)[lists.offset:lists.offset + len(lists) + 1]
    return lists.buffers()[2][offsets[0]:offsets[-1]].to_pybytes()


def _lists(run: bytes, n: np.ndarray) -> pa.Array:
    """The packed lists of a run again, ``n`` positions in each."""
    ends = np.flatnonzero(np.frombuffer(run, dtype=np.uint8) < 128) + 1
    offsets = np.r_[0, ends[np.cumsum(n) - 1]].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(run)])


def _dealt(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order by bucket, and (bucket, first, end) of each that has members."""
    order = np.argsort(bucket, kind="stable")
    first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    return order, list(zip(bucket[order[first]].tolist(), first.tolist(), [*first[1:].tolist(), len(order)]))


_DEALT = pa.schema([
    ("bucket", pa.int64()), ("chunk", pa.int64()), ("lang", pa.string()), ("head", pa.binary()), ("tail", pa.binary()),
    ("n", pa.binary()), ("at", pa.binary()),
])
_DEALT_SQL = "bucket bigint, chunk bigint, lang string, head binary, tail binary, n binary, at binary"
#: Rows without a chunk name the groups of a bucket: n is how often, and total how many words of the language there were, frequent or not.
_SETTLED = pa.schema([
    ("chunk", pa.int64()), ("lang", pa.string()), ("head", pa.binary()), ("tail", pa.binary()), ("id", pa.binary()),
    ("n", pa.binary()), ("at", pa.binary()), ("total", pa.int64()),
])
_SETTLED_SQL = "chunk bigint, lang string, head binary, tail binary, id binary, n binary, at binary, total bigint"


def _word_rows(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(lang, text) to rows by chunk and bucket; ``head`` holds words with spaces between them."""
    nth = TaskContext.get().partitionId() << 32
    waiting: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}

    def rows(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal nth
        for chunk in _chunks(waiting.pop(lang)):
            words, at = words_at(chunk)
            coded = words.dictionary_encode()
            codes = np.asarray(coded.indices)
            names = coded.dictionary.to_pylist()
            by_word = np.argsort(codes, kind="stable")
            n = np.bincount(codes, minlength=len(names))
            lists = pack(at[by_word], np.cumsum(n) - n)
            order, parts = _dealt(np.array([zlib.crc32(name) % buckets for name in names], dtype=np.int64))
            n, lists = n[order], lists.take(pa.array(order))
            yield pa.RecordBatch.from_pylist([
                {"bucket": bucket, "chunk": nth, "lang": lang, "head": b" ".join(names[i] for i in order[low:high].tolist()),
                 "n": _planes(n[low:high]), "at": _run(lists[low:high])} for bucket, low, high in parts
            ], schema=_DEALT)
            nth += 1

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = text.as_py().encode().lower()  # bytes lower only A-Z
            waiting.setdefault(lang, []).append(data)
            sizes[lang] = sizes.get(lang, 0) + len(data)
            if sizes[lang] >= CHUNK or sum(sizes.values()) >= 4 * CHUNK:
                lang = max(sizes, key=sizes.get)
                del sizes[lang]
                yield from rows(lang)
    for lang in list(waiting):
        yield from rows(lang)


def _extended(table: pa.Table, buckets: int, goes_on: bool) -> pa.Table:
    """One chunk's occurrences merged with themselves: rows by bucket of adjacent phrases, with positions if these are merged again."""
    at, ids = [], []
    for some, n, run in zip(*(table.column(c).to_pylist() for c in ("id", "n", "at"))):
        n = _numbers(n)
        at.append(unpack(_lists(run, n))[0])
        ids.append(np.repeat(_numbers(some, True), n))
    at, ids = np.concatenate(at), np.concatenate(ids)
    order = np.argsort(at)
    at, ids = at[order], ids[order]
    next_to = np.flatnonzero(at[1:] == at[:-1] + 1)
    head, tail, at = ids[next_to], ids[next_to + 1], at[next_to]
    order = np.lexsort((at, tail, head))
    head, tail, at = head[order], tail[order], at[order]
    new = np.flatnonzero(np.r_[len(at) > 0, (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])][:len(at)])
    head, tail, n = head[new], tail[new], np.diff(np.r_[new, len(at)])
    lists = pack(at, new)
    mixed = head.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + tail.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)
    order, parts = _dealt((mixed % np.uint64(buckets)).astype(np.int64))
    head, tail, n, lists = head[order], tail[order], n[order], lists.take(pa.array(order))
    chunk = table.column("chunk")[0].as_py()
    return pa.Table.from_pylist([
        {"bucket": bucket, "chunk": chunk, "head": _planes(head[low:high], True), "tail": _planes(tail[low:high]), "n": _planes(n[low:high]),
         "at": _run(lists[low:high]) if goes_on else None} for bucket, low, high in parts
    ], schema=_DEALT)


def _settled(bucket: int, table: pa.Table, least: int, of_words: bool) -> pa.Table:
    """One bucket's groups counted: the occurrences of the frequent ones by chunk, and rows that name these."""
    rows = table.sort_by("chunk").to_pylist()
    each = [_numbers(r["n"]) for r in rows]
    n = np.concatenate(each)
    edges = np.r_[0, np.cumsum([len(x) for x in each])]
    if of_words:
        langs = sorted({r["lang"] for r in rows})
        lang = np.repeat([langs.index(r["lang"]) for r in rows], np.diff(edges))
        words = pa.array([w for r in rows for w in r["head"].split(b" ")], pa.binary()).dictionary_encode()
        key = lang, np.asarray(words.indices)
    else:
        key = np.concatenate([_numbers(r["head"], True) for r in rows]), np.concatenate([_numbers(r["tail"]) for r in rows])
    order = np.lexsort(key[::-1])
    high, low = key[0][order], key[1][order]
    new = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]
    code = np.empty(len(order), dtype=np.int64)
    code[order] = np.cumsum(new) - 1
    a = np.add.reduceat(n[order], np.flatnonzero(new))
    kept = a >= least
    ids = (bucket << 32) + np.cumsum(kept) - 1
    out = []
    for r, start, end in zip(rows, edges[:-1].tolist(), edges[1:].tolist()):
        some = np.flatnonzero(kept[code[start:end]])
        if r["at"] is not None and len(some):
            some = some[np.argsort(code[start + some])]
            out.append({
                "chunk": r["chunk"], "id": _planes(ids[code[start + some]], True), "n": _planes(n[start + some]),
                "at": _run(_lists(r["at"], n[start:end]).take(pa.array(some))),
            })
    high, low, a, ids = high[new][kept], low[new][kept], a[kept], ids[kept]
    if of_words:
        for nth, name in enumerate(langs):
            mine = np.flatnonzero(high == nth)
            out.append({
                "lang": name, "head": b" ".join(words.dictionary.take(pa.array(low[mine])).to_pylist()), "id": _planes(ids[mine], True),
                "n": _planes(a[mine]), "total": int(n[lang == nth].sum()),
            })
    else:
        out.append({"head": _planes(high, True), "tail": _planes(low), "id": _planes(ids, True), "n": _planes(a)})
    return pa.Table.from_pylist(out, schema=_SETTLED)


def _group_rows(batches: Iterator[pa.RecordBatch], of_words: bool) -> Iterator[pa.RecordBatch]:
    """(lang, head, tail, id, n) of named groups to a row for each: (id, lang, word, a) or (id, head, tail, a)."""
    for batch in batches:
        for lang, head, tail, ids, n in zip(*(batch.column(i).to_pylist() for i in range(5))):
            ids, n = _numbers(ids, True), _numbers(n)
            if not len(ids):
                continue
            if of_words:
                key = pa.array([lang] * len(ids), pa.string()), pa.array(head.split(b" "), pa.binary()).cast(pa.string())
            else:
                key = pa.array(_numbers(head, True)), pa.array(_numbers(tail))
            for low in range(0, len(ids), BATCH):
                columns = [pa.array(ids), *key, pa.array(n)]
                yield pa.RecordBatch.from_arrays(
                    [c.slice(low, BATCH) for c in columns], names=["id", "lang", "word", "a"] if of_words else ["id", "head", "tail", "a"]
                )


def _counted(dealt: DataFrame, least: int, of_words: bool) -> tuple[DataFrame, DataFrame]:
    """The written table of :func:`_settled` for all buckets, and its frequent groups."""
    table = checkpointed(dealt.groupBy("bucket").applyInArrow(
        lambda key, table: _settled(key[0].as_py(), table, least, of_words), _SETTLED_SQL
    ), dense=True)
    key = "lang string, word string" if of_words else "head bigint, tail bigint"
    groups = table.filter("chunk IS NULL").select("lang", "head", "tail", "id", "n").mapInArrow(
        lambda batches: _group_rows(batches, of_words), f"id bigint, {key}, a bigint"
    )
    return table, groups


def _merged(table: DataFrame, buckets: int, goes_on: bool) -> DataFrame:
    return table.filter("chunk IS NOT NULL").select("chunk", "id", "n", "at").groupBy("chunk").applyInArrow(
        lambda chunk: _extended(chunk, buckets, goes_on), _DEALT_SQL
    )


def mine(docs: DataFrame, longest: int = LONGEST, least: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, a) of every frequent phrase of up to ``longest`` words, and (lang, n), the words of each language."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text().alias("text"))
    buckets = -(-(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 1) // BUCKET)
    with scratch(docs.sparkSession) as keep:
        table, groups = _counted(texts.mapInArrow(lambda batches: _word_rows(batches, buckets), _DEALT_SQL), least, True)
        words = keep(table.filter("total IS NOT NULL").groupBy("lang").agg(F.sum("total").cast("bigint").alias("n")).filter("n > 0"))
        named = checkpointed(groups.select("id", "lang", F.lit(1).alias("k"), F.col("word").alias("phrase"), F.col("word").alias("last"), "a"))
        every = [named]
        for k in range(2, longest + 1):
            longer, groups = _counted(_merged(table, buckets, k < longest), least, False)
            discard(table)
            table = longer
            sent = F.broadcast if named.count() <= BROADCAST_GROUPS else lambda names: names
            heads = sent(named.select(F.col("id").alias("head"), "lang", "phrase"))
            tails = sent(named.select(F.col("id").alias("tail"), "last"))
            named = checkpointed(groups.join(heads, "head").join(tails, "tail").select(
                "id", "lang", F.lit(k).alias("k"), F.concat("phrase", F.lit(" "), "last").alias("phrase"), "last", "a"
            ))
            every.append(named)
        phrases = every[0]
        for more in every[1:]:
            phrases = phrases.unionByName(more)
        return keep(phrases.drop("id", "last")), words


def _part(first: Column | int, many: Column | int) -> Column:
    return F.array_join(F.slice("words", first, many), " ")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = FREQUENT, best: int = BEST) -> DataFrame:
    """Each language's first phrases as ``lang, rank, phrase, a, l, r, n, score``.

    A phrase is cut where its score, occurrences in relation to those of both
    parts, is lowest, at the earliest such place. Null texts count as empty, a null
    language as ``und``; rows that repeat count each time; a language without
    frequent phrases has no rows, and an empty table gives none. Columns other than
    ``lang`` and ``text`` play no part. A piece without an end is one chunk however
    long it is.
    """
    phrases, words = mine(docs, longest, least)
    split = phrases.withColumn("words", F.split("phrase", " "))
    candidates = split.filter("k >= 2")
    cuts = candidates.select(
        "lang", "k", "phrase", "a", "words", F.explode(F.expr("sequence(1, k - 1)")).alias("cut")
    ).withColumns({"first": _part(1, F.col("cut")), "rest": _part(F.col("cut") + 1, F.col("k") - F.col("cut"))})
    part = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("a").alias(count))
    # a part of a frequent phrase is frequent, so it has its row
    scored = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).withColumn(
        "score", F.expr(f"CAST(CAST({SCALE} AS DECIMAL(10, 0)) * CAST(a AS DECIMAL(19, 0)) div (l + r) AS BIGINT)")
    )
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "a")).alias("at"))
    # the most frequent longer phrase around each
    inner = candidates.filter("k >= 3").select("lang", "words", "k", "a", F.explode(F.expr("sequence(2, k - 1)")).alias("many")).select(
        "lang", "words", "many", "a", F.explode(F.expr("sequence(1, k - many + 1)")).alias("start")
    ).select("lang", _part(F.col("start"), F.col("many")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = lowest.join(inner, ["lang", "phrase"], "left").filter(
        F.col("around").isNull() | (F.col("around").cast("decimal(20,0)") * 100 < F.col("at.a").cast("decimal(20,0)") * COVERED)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("at.score"), F.desc("at.a"), "phrase")
    # cut off before the shuffle as well: a task gets the best of each other task
    first = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return first.join(words, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "at.a", "at.l", "at.r", "n", "at.score"
    )


#: The same in DuckDB's SQL.
COLLOCATION_SQL = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, piece AS body
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
tokens AS (
  SELECT lang, piece, unnest(words) AS w1, generate_subscripts(words, 1) AS nth
  FROM (SELECT lang, piece, regexp_extract_all(body, '[^\x20\x09]+') AS words FROM pieces)),
runs AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4 FROM tokens
  WINDOW p AS (PARTITION BY piece ORDER BY nth)),
f AS (
  SELECT lang, w1 AS phrase, [w1] AS words, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 30 UNION ALL
  SELECT lang, w1 || ' ' || w2, [w1, w2], count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30 UNION ALL
  SELECT lang, w1 || ' ' || w2 || ' ' || w3, [w1, w2, w3], count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30 UNION ALL
  SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, [w1, w2, w3, w4], count(*) FROM runs WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.words, c.f AS a, x.f AS l, y.f AS r, k, (2000000::HUGEINT * c.f) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, len(words))) AS k FROM f WHERE len(words) >= 2) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[k + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (
  SELECT lang, array_to_string(words[s:s + m - 1], ' ') AS phrase, max(f) AS f
  FROM (SELECT *, unnest(range(1, len(words) - m + 2)) AS s FROM (SELECT *, unnest(range(2, len(words))) AS m FROM f WHERE len(words) >= 3))
  GROUP BY ALL),
kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN around USING (lang, phrase) WHERE around.f IS NULL OR 100 * around.f < 80 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN (SELECT lang, count(*) AS n FROM tokens GROUP BY lang) USING (lang) WHERE rank <= 2000
"""
