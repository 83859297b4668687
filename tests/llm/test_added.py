"""Phrase mining, the hash-tree manifest and MinHash next to brute-force versions on small and odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from aidmatch.llm import collocations as C
from aidmatch.llm import merkle as M
from aidmatch.llm import minhash as H
from aidmatch.llm.common import join_unique, numbered_documents, rows_times
from aidmatch.llm.shingles import shingle_set
from aidmatch.workspace import checkpointed

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- phrases --------------------------------------------------------------------------


def phrases_by_hand(rows, least=30, best=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    out = []
    for (lang, words), a in f.items():
        if len(words) < 2 or a < least:
            continue
        score, cut = min((2000000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words)))
        around = max((b for (other, longer), b in f.items() if b >= least and other == lang and len(words) < len(longer)
                      and any(longer[i:i + len(words)] == words for i in range(len(longer) - len(words) + 1))), default=0)
        if 100 * around < 80 * a:
            out.append((lang, " ".join(words), a, f[lang, words[:cut]], f[lang, words[cut:]], n[lang], score))
    ranked = []
    for lang in n:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(mine[:best])]
    return sorted(ranked)


def mined(df, **options):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r[c] for c in columns) for r in C.collocations(df, **options).collect())


def test_phrases_equal_brute_force_on_odd_texts(spark):
    chance = random.Random(5)
    vocabulary = ["ein", "Ein", "ÉTÉ", "a", "b", "c d", "x\x1cy", "日本", "w"]
    marks = [" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\r\n", "?! ", ""]
    rows = []
    for i in range(300):
        text = "".join(chance.choice(vocabulary) + chance.choice(marks) for _ in range(chance.randrange(0, 60)))
        rows.append((i, text, chance.choice(["en", "de", None, "und", ""]), None, 0))
    rows += [(7, None, "en", None, 0), (None, "", None, None, 0), (7, "a a a a a " * 50, "en", None, 0), (7, "a a a a a " * 50, "en", None, 0)]
    df = spark.createDataFrame(rows, DOCS).withColumns({"at": F.lit(1), "id": F.lit(2), "chunk": F.lit("x")})
    assert mined(df) == phrases_by_hand([(r[1], r[2]) for r in rows])


def test_phrases_do_not_depend_on_chunks(spark, monkeypatch):
    rows = [(i, "one two three. four " * 40 + "five " * (i % 7), "en", None, 0) for i in range(40)] + [(99, "very long piece " * 3000, "en", None, 0)]
    df = spark.createDataFrame(rows, DOCS)
    whole = mined(df)
    texts = [r[1].encode() for r in rows]
    monkeypatch.setattr(C, "CHUNK", 500)
    cut = list(C._chunks(texts))
    assert len(cut) > 50
    assert Counter(w for c in cut for w in re.findall(rb"[a-z]+|\.", c)) == Counter(w for t in texts for w in re.findall(rb"[a-z]+|\.", t))
    counts = Counter()
    for chunk in cut:
        words, at = C.words_at(chunk)
        words = [w.decode() for w in words.to_pylist()]
        counts.update((a, b) for a, b, i, j in zip(words, words[1:], at, at[1:]) if j == i + 1)
    for _, _, phrase, a, *_ in whole:
        if phrase.count(" ") == 1:
            assert counts[tuple(phrase.split(" "))] == a


def test_positions_survive_packing():
    chance = np.random.default_rng(4)
    lists = [np.unique(chance.integers(0, 1 << int(chance.integers(1, 31)), chance.integers(1, 40))) for _ in range(500)]
    first = np.r_[0, np.cumsum([len(x) for x in lists])[:-1]]
    packed = C.pack(np.concatenate(lists), first)
    at, counts = C.unpack(packed)
    assert [x.tolist() for x in np.split(at, np.cumsum(counts)[:-1])] == [x.tolist() for x in lists]
    some, counts = C.unpack(packed.slice(100, 50))
    assert some.tolist() == np.concatenate(lists[100:150]).tolist() and counts.tolist() == [len(x) for x in lists[100:150]]
    assert [len(x) for x in C.unpack(C.pack(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)))] == [0, 0]


def test_phrases_of_an_empty_table(spark):
    assert mined(spark.createDataFrame([], DOCS)) == []


def test_phrases_with_many_frequent_groups(spark, monkeypatch):
    monkeypatch.setattr(C, "BROADCAST_GROUPS", 0)
    rows = [(i, "one two three. four five " * 9, "en", None, 0) for i in range(20)]
    assert mined(spark.createDataFrame(rows, DOCS)) == phrases_by_hand([(r[1], r[2]) for r in rows])


def test_rare_phrases_are_not_written(spark, monkeypatch):
    chance = random.Random(8)
    rows = [(i, "rare " + " ".join(f"w{chance.randrange(60)}" for _ in range(200)) + ". often seen here again", "en" if i % 3 else None, None, 0)
            for i in range(90)]
    written = []

    def noted(df, *args, **options):
        table = checkpointed(df, *args, **options)
        written.append(table.count())
        return table
    monkeypatch.setattr(C, "checkpointed", noted)
    # no table has a row for each of some 3,600 pairs, of which hardly any is frequent
    assert mined(spark.createDataFrame(rows, DOCS)) == phrases_by_hand([(r[1], r[2]) for r in rows])
    assert max(written) < 400
    if hasattr(C, "BUCKET"):
        monkeypatch.setattr(C, "BUCKET", 300)
        monkeypatch.setattr(C, "CHUNK", 2000)
        assert mined(spark.createDataFrame(rows, DOCS)) == phrases_by_hand([(r[1], r[2]) for r in rows])


def test_best_phrases_only(spark):
    rows = [(i, " ".join(f"w{j} v{j}." for j in range(20)), "en", None, 0) for i in range(30)]
    found = mined(spark.createDataFrame(rows, DOCS), best=3)
    assert found == phrases_by_hand([(r[1], r[2]) for r in rows], best=3) and len(found) == 3


# --- manifest -------------------------------------------------------------------------


def manifest_by_hand(rows):
    H_ = lambda s: hashlib.sha256(s.encode()).hexdigest()
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf_of = lambda r, text: H_("".join(map(enc, (r[0], r[3], r[2], r[4], text))))

    def tree(nodes):
        """root, and for each leaf its steps [(left, right), ...]"""
        steps, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            up, joined = [], []
            for at in range(0, len(nodes), 8):
                run = nodes[at:at + 8]
                for j in range(len(run)):
                    for i in groups[at + j]:
                        steps[i].append((run[:j], run[j + 1:]))
                up.append(H_("".join(run)))
                joined.append([i for g in groups[at:at + 8] for i in g])
            nodes, groups = up, joined
        return nodes[0], steps

    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append((r[0] is not None, r[0] or 0, leaf_of(r, r[1]), r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    subs = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: x[:3])
        subs[lang] = tree([x[2] for x in by_lang[lang]])
    root, top = tree([subs[lang][0] for lang in langs])
    out = []
    for at, lang in enumerate(langs):
        subroot, steps = subs[lang]
        for (_, _, own, r), mine in zip(by_lang[lang], steps):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            node, proof = leaf_of(r, None if r[1] is None else lower(r[1])) if hit else own, ""
            for left, right in mine + top[at]:
                proof += "".join(left + right)
                node = H_("".join(left) + node + "".join(right))
            out.append((r[0], own, subroot, root, H_(proof), node, node == root))
    return sorted(out, key=str)


def manifested(df):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[c] for c in columns) for r in M.audited(df).collect()), key=str)


@pytest.mark.parametrize("many", [1, 8, 9, 65])
def test_manifest_of_one_language(spark, many):
    rows = [(i, f"Text {i}", "en", "s", i) for i in range(many)]
    assert manifested(spark.createDataFrame(rows, DOCS)) == manifest_by_hand(rows)


def test_manifest_over_two_stored_levels_and_odd_rows(spark):
    rows = [(i, f"Text {i}" if i % 5 else None, "en" if i % 3 else "de", "s" if i % 7 else None, i) for i in range(1700)]
    rows += [(None, "A", "en", "s", 1), (None, "A", "en", "s", 1), (3, "B", None, None, None), (-5, "", "", "", 0), (3, "B" * 200_000, "日本", "é", 0)]
    rows += [(5000 + i, "T", f"l{i}", "s", 0) for i in range(12)]
    df = spark.createDataFrame(rows, DOCS).withColumns({"tree": F.lit("x"), "pos": F.lit(9), "node": F.lit("n")})
    assert manifested(df) == manifest_by_hand(rows)


def test_manifest_of_an_empty_table(spark):
    assert manifested(spark.createDataFrame([], DOCS)) == []


# --- near duplicates ------------------------------------------------------------------


def classes_by_hand(rows):
    sets = [frozenset(shingle_set(text or "", 4).tolist()) for _, text in rows]
    first = list(range(len(rows)))

    def find(i):
        while first[i] != i:
            i = first[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                first[find(i)] = find(j)
    named = defaultdict(list)
    for i, (id_, _) in enumerate(rows):
        named[find(i)].append(id_)
    out = []
    for i, (id_, _) in enumerate(rows):
        ids = [x for x in named[find(i)] if x is not None] if sets[i] else [id_]
        least = min(ids, default=None) if sets[i] else id_
        out.append((id_, len(sets[i]), least, id_ == least))
    return sorted(out, key=str)


def classed(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in H.minhash_duplicates(df).collect()), key=str)


def near_rows():
    chance = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows, nth = [], 0
    for size in (4, 9, 25, 60, 200):
        for _ in range(6):
            base = [chance.choice(words) for _ in range(size)]
            for _ in range(6):
                text = list(base)
                for _ in range(chance.randrange(0, max(2, size // 12))):
                    text[chance.randrange(size)] = chance.choice(words)
                rows.append((nth, " ".join(text)))
                nth += 1
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "one two"), (905, "one two"), (None, "one two"),
             (None, "only null"), (906, "x y z " * 40_000), (907, "x y z " * 40_000 + "end")]
    return rows


def test_classes_equal_brute_force(spark):
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"row_id": F.lit(1), "digest": F.lit("d"), "sid": F.lit(0)})
    assert classed(df) == classes_by_hand(rows)


def test_classes_where_hubs_settle_nothing(spark, monkeypatch):
    """Chains of sets that are near their neighbours only: what turns do not find the blocks do."""
    chance = random.Random(8)
    rows, text = [], [f"c{i}" for i in range(60)]
    for i in range(120):
        text = list(text)
        text[chance.randrange(60)] = f"n{i}"
        rows.append((i, " ".join(text)))
    monkeypatch.setattr(H, "MEET", 1)
    monkeypatch.setattr(H, "BLOCK_BYTES", 2000)
    assert classed(spark.createDataFrame(rows, "doc_id bigint, text string")) == classes_by_hand(rows)


def test_classes_of_an_empty_table(spark):
    assert classed(spark.createDataFrame([], "doc_id bigint, text string")) == []


def test_minima_agree_as_often_as_sets_do():
    chance = np.random.default_rng(2)
    share = []
    for _ in range(60):
        x = chance.integers(0, 1 << 63, 1000, dtype=np.uint64)
        share.append((H.minima(x[:900]) == H.minima(x[100:])).mean())
    assert abs(np.mean(share) - 0.8) < 0.02


# --- helpers --------------------------------------------------------------------------


def test_rows_of_a_table_are_told_apart_without_writing_it(spark, tmp_path):
    path = str(tmp_path / "t")
    for part in range(2):  # two writes into one table, several files a task
        spark.range(100).coalesce(1).write.option("maxRecordsPerFile", 10).mode("append").parquet(path)
    rows = numbered_documents(spark.read.parquet(path))
    assert rows.select("row_id").distinct().count() == 200
    twice = spark.read.parquet(path).crossJoin(spark.range(2).withColumnRenamed("id", "k"))
    assert numbered_documents(twice).select("row_id").distinct().count() == 400


def test_rows_times(spark):
    rows = checkpointed(spark.range(1000).select(F.col("id").alias("row_id"), (F.col("id") * 3).alias("x")))
    times = rows.select("row_id", (F.col("row_id") % 4).alias("copies")).filter("row_id % 5 <> 0")
    got = Counter(r.row_id for r in rows_times(rows, times, 3).collect())
    assert got == Counter({i: i % 4 for i in range(1000) if i % 5 and i % 4})


def test_join_unique_splits_hot_keys(spark):
    left = checkpointed(spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).when(F.col("id") % 100 > 0, F.col("id")).alias("k")))
    right = spark.range(0, 30_000, 2).union(spark.createDataFrame([(7,)], "id bigint")).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        plain = left.join(right, "k", how)
        assert join_unique(left, right, "k", how).exceptAll(plain).count() == 0 and join_unique(left, right, "k", how).count() == plain.count()
