"""How many circles cover each point, and how near and far their centres are, without the pairs.

Points and circles meet in the cubes of the grid, crowded cubes in blocks of bounded
sides. In a block the points are halved again and again; a circle that holds all of a
part is counted once for the part, one that holds none of it is left out, and only
circles whose edge runs through the part go on to its halves. Of the circles that hold a
part only those stay that can be the nearest or the farthest for one of its points.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidmatch.functions.geo import EARTH_RADIUS_KM, haversine
from aidmatch.functions.grid import BROADCAST_CUBES, CELL, circle_cells, in_blocks, point_cells
from aidmatch.workspace import checkpointed

# Points and circles of one block at most (about 100 bytes each).
BLOCK_POINTS, BLOCK_CIRCLES = 1 << 17, 1 << 18
# Points of a part that is compared pair by pair, and pairs that are compared in any case.
LEAF_POINTS, LEAF_PAIRS = 64, 1 << 14
_PAIRS_AT_ONCE = 1 << 20
_SLACK_KM = 1e-5


def _distances(lat, lon, clat, other_lat, other_lon, other_clat):
    half = np.sin((lat - other_lat) / 2) ** 2 + other_clat * clat * np.sin((lon - other_lon) / 2) ** 2
    return EARTH_RADIUS_KM * 2 * np.arctan2(np.sqrt(half), np.sqrt(np.maximum(0.0, 1 - half)))


def _place(lat, lon, clat):
    return EARTH_RADIUS_KM * np.stack([clat * np.cos(lon), clat * np.sin(lon), np.sin(lat)])


def count_cover(points: np.ndarray, circles: np.ndarray) -> tuple[np.ndarray, ...]:
    """Count, nearest and farthest for each column of ``points`` (rlat, rlon, clat) under ``circles`` (rlat, rlon, clat, reach).

    The centres (rlat, rlon, clat) of the nearest and the farthest come after these; they mean nothing where the count is 0.
    """
    # alike ones count as often as they are there
    points, back = np.unique(points, axis=1, return_inverse=True)
    circles, weight = np.unique(circles, axis=1, return_counts=True)
    reach = circles[3]
    at, centre = _place(*points), _place(*circles[:3])
    chord = 2 * EARTH_RADIUS_KM * np.sin(np.minimum(reach / (2 * EARTH_RADIUS_KM), np.pi / 2))
    total = np.zeros(points.shape[1], dtype=np.int64)
    nearest, farthest = np.full(points.shape[1], np.inf), np.full(points.shape[1], -np.inf)

    near_at, far_at = (np.zeros(points.shape[1], dtype=np.int64) for _ in range(2))

    def compare(own: np.ndarray, some: np.ndarray, known: bool) -> None:
        step = max(1, _PAIRS_AT_ONCE // max(1, len(own)))
        for low in range(0, len(some), step):
            them = some[low:low + step]
            line = np.sqrt(sum((at[i, own][:, None] - centre[i, them]) ** 2 for i in range(3)))
            if known:
                fit = np.ones(line.shape, dtype=bool)
            else:
                fit = line < chord[them] - _SLACK_KM
                p, c = np.nonzero(~fit & (line <= chord[them] + _SLACK_KM))
                fit[p, c] = _distances(*points[:, own[p]], *circles[:3, them[c]]) <= reach[them[c]]
                total[own] += fit @ weight[them]
            any_ = np.flatnonzero(fit.any(axis=1))
            who = own[any_]
            for best, where, empty, pick, better in (
                (nearest, near_at, np.inf, np.argmin, np.less), (farthest, far_at, -np.inf, np.argmax, np.greater)
            ):
                chosen = them[pick(np.where(fit[any_], line[any_], empty), axis=1)]
                away = _distances(*points[:, who], *circles[:3, chosen])
                new = better(away, best[who])
                best[who[new]], where[who[new]] = away[new], chosen[new]

    none = np.empty(0, dtype=np.int64)
    parts = [(np.arange(points.shape[1]), np.arange(circles.shape[1]), none, none)]
    while parts:
        own, open_, near, far = parts.pop()
        place = at[:, own]
        low, high = place.min(axis=1), place.max(axis=1)
        middle = (low + high) / 2
        wide = np.sqrt(((place - middle[:, None]) ** 2).sum(axis=0).max())

        def off(some):
            return np.sqrt(((centre[:, some] - middle[:, None]) ** 2).sum(axis=0))

        away = off(open_)
        whole = away + wide < chord[open_] - _SLACK_KM
        total[own] += weight[open_[whole]].sum()
        near, far = np.concatenate([near, open_[whole]]), np.concatenate([far, open_[whole]])
        open_ = open_[~whole & (away - wide <= chord[open_] + _SLACK_KM)]
        if len(near):
            away = off(near)
            near = near[away - wide <= (away + wide).min() + _SLACK_KM]
            away = off(far)
            far = far[away + wide >= (away - wide).max() - _SLACK_KM]
        if len(own) <= LEAF_POINTS or len(own) * (len(open_) + len(near) + len(far)) <= LEAF_PAIRS:
            compare(own, open_, known=False)
            compare(own, near, known=True)
            compare(own, far, known=True)
        else:
            half = np.argpartition(place[(high - low).argmax()], len(own) // 2)
            parts += [(own[side], open_, near, far) for side in (half[:len(own) // 2], half[len(own) // 2:])]
    return total[back], nearest[back], farthest[back], circles[:3, near_at[back]], circles[:3, far_at[back]]


_ANGLES = ["rlat", "rlon", "clat"]
_BLOCK = ["point", "eligible", *(f"{side}_{c}" for side in ("own", "near", "far") for c in _ANGLES)]


def _block(points: pd.DataFrame, circles: pd.DataFrame) -> pd.DataFrame:
    points, circles = (side[np.isfinite(side["rlat"] + side["rlon"])] for side in (points, circles))
    if not len(points) or not len(circles):
        return pd.DataFrame({c: [] for c in _BLOCK})
    sides = [df[cols].to_numpy(dtype=float).T for df, cols in ((points, _ANGLES), (circles, [*_ANGLES, "reach"]))]
    total, _, _, near, far = count_cover(*sides)
    out = pd.DataFrame(dict(zip(_BLOCK, (points["point"].to_numpy(), total, *sides[0], *near, *far))))
    return out[out["eligible"] > 0]


def coverage(points: DataFrame, circles: DataFrame, on: list[str], levels: list[int]) -> DataFrame:
    """(point, eligible, nearest, farthest), at most one row for a point, cube and block; the caller puts them together.

    ``points`` (on, point, p_pos) and ``circles`` (on, c_pos, reach) are written tables.
    """
    key = [*on, *CELL]
    flat = [F.col(f"pos.{c}").alias(c) for c in ("rlat", "rlon", "clat")]
    points = point_cells(points.withColumnRenamed("p_pos", "pos"), "pos", levels).select(*key, "point", *flat)
    circles = circle_cells(circles.withColumnRenamed("c_pos", "pos"), "pos", "reach").select(*key, *flat, "reach")
    cubes = checkpointed(
        points.groupBy(*key).agg(F.count("*").alias("p")).join(circles.groupBy(*key).agg(F.count("*").alias("c")), key).select(
            *key, F.ceil(F.col("p") / BLOCK_POINTS).cast("int").alias("p_cuts"), F.ceil(F.col("c") / BLOCK_CIRCLES).cast("int").alias("c_cuts")
        )
    )
    few = F.broadcast(cubes) if cubes.count() <= BROADCAST_CUBES else cubes
    # rows that are alike must not share a block only because of that
    spread = "_nth"
    points, circles = (side.withColumn(spread, F.monotonically_increasing_id()) for side in (points, circles))
    block = [*key, "p_cuts", "c_cuts"]
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = [
        in_blocks(side, few, key, own, other).drop(spread).repartition(tasks, *block).groupBy(*block)
        for side, own, other in ((points, "p_cuts", "c_cuts"), (circles, "c_cuts", "p_cuts"))
    ]
    shape = ", ".join(f"{c} {'bigint' if c in ('point', 'eligible') else 'double'}" for c in _BLOCK)
    found = sides[0].cogroup(sides[1]).applyInPandas(_block, shape)
    own, near, far = (F.struct(*(F.col(f"{side}_{c}").alias(c) for c in _ANGLES)) for side in ("own", "near", "far"))
    # the distances themselves are those of the other joins, to the last bit
    return found.select("point", "eligible", haversine(near, own).alias("nearest"), haversine(far, own).alias("farthest"))
