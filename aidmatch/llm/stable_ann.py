"""Nearest neighbours by few stable projections and kd-trees.

Vectors are projected to ``PROJECTIONS`` Gaussian (2-stable) directions. The
squared projected distance over the squared true distance then follows a
chi-square law, so points met in the order of projected distance can stop: once
a point as near as the k-th best so far would have shown up by now with
probability ``CERTAIN``, the search ends. Every point met is verified with the
exact inner product.

Largest inner product becomes least distance by one more component,
sqrt(M^2 - |x|^2) with M the largest norm, 0 for queries.

The upper kd-tree is fitted on a bounded sample and cuts the projected space to
cells, each row is in one cell, and a cell is searched in blocks of bounded size
with a kd-tree each. A query first searches its own cell, then exactly those
others that the test cannot rule out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aidmatch.workspace import checkpointed

PROJECTIONS = 8
CERTAIN = 0.98
#: Rows the upper tree is fitted on, those with the smallest hashes of their ids.
SAMPLE = 20_000
#: Rows of a cell on average, rows of a block and queries of a lot.
CELL, BLOCK, LOT = 20_000, 20_000, 4_000
LEAF = 64
LEAVES_AT_ONCE = 8
QUERIES_AT_ONCE = 512
CELLS_AT_ONCE = 4096


def chi_square(x: np.ndarray) -> np.ndarray:
    """The distribution function for ``PROJECTIONS`` degrees of freedom, an even number."""
    half = np.minimum(np.asarray(x, dtype=np.float64) / 2, 700)
    return 1 - np.exp(-half) * sum(half**i / factorial(i) for i in range(PROJECTIONS // 2))


@lru_cache(maxsize=4)
def directions(dimension: int) -> np.ndarray:
    return np.random.default_rng(7).standard_normal((dimension + 1, PROJECTIONS))


def project(vectors: np.ndarray, top: float, query: bool) -> np.ndarray:
    extra = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(top - (vectors**2).sum(axis=1), 0))
    return np.hstack([vectors, extra[:, None]]) @ directions(vectors.shape[1])


def kd_leaves(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Positions of the points of each leaf; halves along the widest side."""
    leaves, open_ = [], [np.arange(len(points))]
    while open_:
        some = open_.pop()
        if len(some) <= size:
            leaves.append(some)
            continue
        side = int(np.ptp(points[some], axis=0).argmax())
        middle = len(some) // 2
        order = np.argpartition(points[some, side], middle)
        open_ += [some[order[:middle]], some[order[middle:]]]
    return leaves


def fit_cells(points: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A kd-tree of ``cells`` (a power of two) leaves as heap arrays: side and cut of inner nodes, and open boxes of the leaves."""
    sides, cuts = np.zeros(cells, dtype=np.int64), np.zeros(cells)
    boxes = np.tile(np.array([-np.inf, np.inf]), (2 * cells, PROJECTIONS, 1))
    members = {1: np.arange(len(points))}
    for node in range(1, cells):
        some = members.pop(node)
        side = int(np.ptp(points[some], axis=0).argmax()) if len(some) else 0
        cut = float(np.median(points[some, side])) if len(some) else 0.0
        sides[node], cuts[node] = side, cut
        boxes[2 * node], boxes[2 * node + 1] = boxes[node], boxes[node]
        boxes[2 * node, side, 1] = boxes[2 * node + 1, side, 0] = cut
        low = points[some, side] <= cut
        members[2 * node], members[2 * node + 1] = some[low], some[~low]
    return sides, cuts, boxes[cells:]


def cell_of(points: np.ndarray, sides: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    node = np.ones(len(points), dtype=np.int64)
    for _ in range(int(np.log2(len(sides)))):
        node = 2 * node + (points[np.arange(len(points)), sides[node]] > cuts[node])
    return node - len(sides)


def ruled_out(near: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Whether what is at a squared projected distance of ``near`` or more can be left out; ``gap`` is infinite where too few are known."""
    some = np.where(gap > 0, gap, 1)
    return np.where(gap > 0, chi_square(near / some) >= CERTAIN, near > 0)


def _first(k: int, query: np.ndarray, name: np.ndarray, score: np.ndarray, slack: np.ndarray) -> np.ndarray:
    """Places of each query's ``k`` largest scores, ties to smaller names, and of what is behind the k-th by ``slack`` at most."""
    order = np.lexsort((name, -score, query))
    starts = np.searchsorted(query[order], np.arange(len(slack)))
    nth = np.arange(len(order)) - starts[query[order]]
    kth = np.full(len(slack), -np.inf)
    kth[query[order[nth == k - 1]]] = score[order[nth == k - 1]]
    return order[(nth < k) | (score[order] >= (kth - slack)[query[order]]) & (slack[query[order]] > 0)]


def search_block(names: np.ndarray, vectors: np.ndarray, queries: pd.DataFrame, top: float, k: int) -> pd.DataFrame:
    """Best candidates of a block for each query (query_id, vector, worst); ``worst`` is the k-th score known before.

    Queries go side by side: in each round, which doubles the leaves met, a leaf is
    multiplied with all queries that it is still open for. What may be among the
    best is verified by sums that do not depend on the place of a vector.
    """
    points = project(vectors, top, False)
    leaves = kd_leaves(points, LEAF)
    low = np.array([points[leaf].min(axis=0) for leaf in leaves])
    high = np.array([points[leaf].max(axis=0) for leaf in leaves])
    held = [np.ascontiguousarray(vectors[leaf]) for leaf in leaves]
    out = []
    for start in range(0, len(queries), QUERIES_AT_ONCE):
        some = queries.iloc[start:start + QUERIES_AT_ONCE]
        own, wanted = some["query_id"].to_numpy(), np.stack(some["vector"].to_numpy()).astype(np.float64)
        at = project(wanted, top, True)
        near = sum(np.maximum(np.maximum(low[:, i] - at[:, i:i + 1], at[:, i:i + 1] - high[:, i]), 0) ** 2 for i in range(PROJECTIONS))
        rank = near.argsort(axis=1, kind="stable").argsort(axis=1, kind="stable")
        length = (wanted**2).sum(axis=1) + top
        slack = 1e-15 * wanted.shape[1] * length  # more than the rounding of a product
        worst = some["worst"].to_numpy(dtype=np.float64, na_value=np.nan)
        worst = np.where(np.isnan(worst), -np.inf, worst)
        best = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)  # place of the query, name, score
        done, last = 0, LEAVES_AT_ONCE
        while done < len(leaves):
            open_ = (rank >= done) & (rank < last) & ~ruled_out(near, (length - 2 * worst)[:, None])
            bound = worst - slack
            query, place, score = [], [], []
            for nth in np.flatnonzero(open_.any(axis=0)):
                asking = np.flatnonzero(open_[:, nth])
                scores = wanted[asking] @ held[nth].T
                i, j = np.nonzero(scores >= bound[asking, None])
                query.append(asking[i]), place.append(leaves[nth][j]), score.append(scores[i, j])
            if not query:
                break
            query, place, score = map(np.concatenate, (query, place, score))
            other = names[place] != own[query]
            query, place, score = query[other], place[other], score[other]
            kept = _first(k, query, names[place], score, slack)
            query, place = query[kept], place[kept]
            score = (vectors[place] * wanted[query]).sum(axis=1)
            fits = score >= worst[query]
            best = np.r_[best[0], query[fits]], np.r_[best[1], names[place[fits]]], np.r_[best[2], score[fits]]
            kept = _first(k, *best, np.zeros(len(own)))
            best = best[0][kept], best[1][kept], best[2][kept]
            counts = np.bincount(best[0], minlength=len(own))
            full = np.flatnonzero(counts == k)
            worst[full] = np.maximum(worst[full], best[2][np.cumsum(counts)[full] - 1])
            done, last = last, 2 * last
        out.append(pd.DataFrame({"query_id": own[best[0]], "vec_id": best[1], "score": best[2]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner product for each query.

    Both tables hold ``vec_id`` and ``embedding``. Vectors that are null, zero,
    of another length than most rows, or hold null or non-finite components take
    no part; a query never finds its own id; ties go to smaller ids; fewer rows
    than ``k`` give fewer results; empty tables give none. Of equal vectors only
    the ``k + 1`` smallest ids can be found, so no more are searched. Rows that
    repeat count once, and so do queries.
    """
    spark = rows.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        vector = F.transform("embedding", lambda x: x.cast("double"))
        odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
        return df.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").select(
            F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector")
        ).filter(~F.exists("vector", odd) & F.exists("vector", lambda x: x != 0))

    copies = Window.partitionBy("vector").orderBy("vec_id")
    # a row that repeats would hide other ids with its vector
    single = usable(rows).distinct().withColumn("nth", F.row_number().over(copies)).filter(F.col("nth") <= k + 1).drop("nth")
    clean = checkpointed(single.withColumn("norm", F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)))
    sizes = clean.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"), F.max("norm").alias("top"))
    most = sizes.orderBy(F.desc("n"), "size").first()
    if most is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dimension, total, top = most["size"], most["n"], float(most["top"])
    clean = clean.filter(F.size("vector") == dimension)

    sample = clean.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").toPandas()  # bounded
    cells = 1 << max(0, int(np.ceil(np.log2(total / CELL))))
    sides, cuts, boxes = fit_cells(project(np.stack(sample["vector"].to_numpy()), top, False), cells)

    def located(df: DataFrame, query: bool) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield batch.assign(cell=cell_of(project(np.stack(batch["vector"].to_numpy()), top, query), sides, cuts))
        return df.select("vec_id", "vector").mapInPandas(run, "vec_id bigint, vector array<double>, cell bigint")

    placed = located(clean, False).join(
        located(clean, False).groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), "cell"
    ).withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks"))
    placed = checkpointed(placed)
    blocks = placed.select("cell", "blocks").distinct()
    asked = checkpointed(located(usable(queries).distinct().filter(F.size("vector") == dimension), True).withColumnRenamed("vec_id", "query_id"))

    def search(to: DataFrame) -> DataFrame:
        """``to`` holds query_id, vector, cell and worst."""
        lots = to.groupBy("cell").agg(F.ceil(F.count("*") / LOT).alias("lots"))
        each = to.join(lots, "cell").join(blocks, "cell").withColumn("lot", F.pmod(F.xxhash64("query_id"), "lots")).withColumn(
            "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
        ).select("query_id", "vector", "worst", "cell", "block", "lot")
        held = placed.join(lots, "cell").withColumn("lot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("lots") - 1)))

        def run(some: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
            if not len(some) or not len(wanted):
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
            return search_block(some["vec_id"].to_numpy(), np.stack(some["vector"].to_numpy()), wanted, top, k)

        keys = ["cell", "block", "lot"]
        return held.select(*keys, "vec_id", "vector").groupBy(*keys).cogroup(each.groupBy(*keys)).applyInPandas(
            run, "query_id bigint, vec_id bigint, score double"
        )

    def best(found: DataFrame) -> DataFrame:
        first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)

    home = checkpointed(best(search(asked.withColumn("worst", F.lit(None).cast("double")))))
    known = home.filter(F.col("rank") == k).select("query_id", F.col("score").alias("worst"))

    def open_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), QUERIES_AT_ONCE):
                some = batch.iloc[start:start + QUERIES_AT_ONCE]
                vectors = np.stack(some["vector"].to_numpy())
                at, worst = project(vectors, top, True), some["worst"].to_numpy(dtype=np.float64, na_value=np.nan)
                gap = np.where(np.isnan(worst), np.inf, (vectors**2).sum(axis=1) + top - 2 * worst)
                for low in range(0, cells, CELLS_AT_ONCE):
                    near = np.zeros((len(some), min(cells - low, CELLS_AT_ONCE)))
                    for i in range(PROJECTIONS):
                        box = boxes[low:low + CELLS_AT_ONCE, i]
                        near += np.maximum(np.maximum(box[:, 0] - at[:, i:i + 1], at[:, i:i + 1] - box[:, 1]), 0) ** 2
                    query, cell = np.nonzero(~ruled_out(near, gap[:, None]))
                    other = cell + low != some["cell"].to_numpy()[query]
                    yield some.iloc[query[other]][["query_id", "vector"]].assign(
                        cell=cell[other] + low, worst=some["worst"].to_numpy()[query[other]]
                    )

    further = asked.join(known, "query_id", "left").mapInPandas(
        open_cells, "query_id bigint, vector array<double>, cell bigint, worst double"
    )
    found = home.select("query_id", "vec_id", "score").unionByName(search(checkpointed(further))) if cells > 1 else home.drop("rank")
    return best(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
