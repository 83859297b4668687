"""A cube grid over the sphere that turns distance joins into equi-joins.

Positions become 3-D points in kilometres, so neither the poles nor the 180th
meridian need special care, and a straight line is never longer than the
great-circle distance it cuts. Level ``k`` has cubes of edge 16384 / 2**k km;
level 0 is one cube around the whole Earth.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aidmatch.functions.geo import EARTH_RADIUS_KM, haversine
from aidmatch.workspace import checkpointed

TOP_EDGE_KM = 16384.0
LEVELS = list(range(21))
_SLACK_KM = 1e-5
_WIDTH_KM = 2.0 * EARTH_RADIUS_KM + 2.0
CELL = ["level", "cx", "cy", "cz"]


def _axes(pos):
    """x, y, z of a position, shifted so that every coordinate is positive."""
    shift = _WIDTH_KM / 2
    return [
        EARTH_RADIUS_KM * pos["clat"] * F.cos(pos["rlon"]) + shift,
        EARTH_RADIUS_KM * pos["clat"] * F.sin(pos["rlon"]) + shift,
        EARTH_RADIUS_KM * F.sin(pos["rlat"]) + shift,
    ]


def edge_km(level: int) -> float:
    return TOP_EDGE_KM / 2**level


def diagonal_km(level: int) -> float:
    """Great-circle distance that no two points of one cube exceed."""
    half = min(1.0, math.sqrt(3) * edge_km(level) / (2 * EARTH_RADIUS_KM))
    return 2 * EARTH_RADIUS_KM * math.asin(half) + _SLACK_KM


def _edge(level):
    return F.lit(TOP_EDGE_KM) / F.pow(F.lit(2.0), level)


def level_for(radius_km: Column) -> Column:
    """Finest level whose cubes are at least as wide as the circle."""
    wide = 2 * (F.least(F.greatest(radius_km, F.lit(0.0)), F.lit(2.0 * EARTH_RADIUS_KM)) + _SLACK_KM)
    level = F.floor(F.log(F.lit(TOP_EDGE_KM) / wide) / F.log(F.lit(2.0)))
    return F.greatest(F.lit(0), F.least(level, F.lit(LEVELS[-1]))).cast("int")


def point_cells(df: DataFrame, pos: str, levels=LEVELS) -> DataFrame:
    """One row per level: the cube that holds the point."""
    axes = _axes(F.col(pos))
    out = df.withColumn("level", F.explode(F.array(*[F.lit(k) for k in levels])))
    return out.withColumns({
        name: F.floor(axis / _edge(F.col("level"))).cast("int") for name, axis in zip(CELL[1:], axes)
    })


def circle_cells(df: DataFrame, pos: str, radius: str, level: int | None = None) -> DataFrame:
    """At most eight rows: the cubes a circle can touch, at the level of its size or a coarser one."""
    out = df.withColumn("level", level_for(F.col(radius)) if level is None else F.lit(level))
    reach = F.least(F.greatest(F.col(radius), F.lit(0.0)), F.lit(2.0 * EARTH_RADIUS_KM)) + _SLACK_KM
    for name, axis in zip(CELL[1:], _axes(F.col(pos))):
        edge = _edge(F.col("level"))
        # Clipped to the Earth, so that a circle around it all stays in the one top cube.
        low, high = F.greatest(axis - reach, F.lit(0.0)), F.least(axis + reach, F.lit(_WIDTH_KM))
        ends = [F.floor(end / edge).cast("int") for end in (low, high)]
        out = out.withColumn(name, F.explode(F.array_distinct(F.array(*ends))))
    return out


def level_of(radius: float) -> int:
    """Finest level whose cubes are as wide as a circle of this radius."""
    return max(k for k in LEVELS if k == 0 or edge_km(k) >= 2 * radius)


def reach_of(asked: DataFrame, seats: DataFrame, on: list, many: int, widest: float) -> DataFrame:
    """Add ``reach`` to ``asked`` (``pos``): a distance that surely holds ``many`` seats that cover it, or else all of them.

    A cube around the point with enough ``seats`` (``pos``, ``radius``) whose
    circles span the whole cube gives its diagonal; without any it is the widest
    radius.
    """
    levels = [k for k in LEVELS if diagonal_km(k) <= widest]
    if not levels:
        return asked.withColumn("reach", F.lit(widest))
    diagonal = F.element_at(F.array(*[F.lit(diagonal_km(k)) for k in LEVELS]), F.col("level") + 1)
    full = (
        point_cells(seats.select(*on, "pos", "radius"), "pos", levels)
        .filter(F.col("radius") >= diagonal)
        .groupBy(*on, *CELL)
        .agg(F.count("*").alias("free"))
        .filter(F.col("free") >= many)
        .drop("free")
    )
    spans = point_cells(asked, "pos", levels).join(full, [*on, *CELL]).groupBy(*on, "pos").agg(F.min(diagonal).alias("span"))
    return asked.join(spans, [*on, "pos"], "left").withColumn("reach", F.coalesce("span", F.lit(widest))).drop("span")


# Pairs of one block of a crowded cube at most and at least; between them, blocks per task.
MOST_PAIRS, LEAST_PAIRS, BLOCKS_PER_TASK = 1 << 22, 1 << 14, 32
# Crowded cubes up to this count are broadcast (about 100 bytes each).
BROADCAST_CUBES = 50_000


def crowded_cubes(points: DataFrame, circles: DataFrame, key: list, tasks: int) -> DataFrame | None:
    """(*key, p_cuts, c_cuts) of cubes whose pairs are too many for one block, so that blocks are alike in pairs.

    Counts only, from both sides; None if there is no such cube.
    """
    pairs = checkpointed(
        points.groupBy(*key).agg(F.count("*").alias("p")).join(circles.groupBy(*key).agg(F.count("*").alias("c")), key)
    )
    total = pairs.agg(F.sum(F.col("p").cast("double") * F.col("c"))).first()[0] or 0.0
    block = int(min(MOST_PAIRS, max(LEAST_PAIRS, total / (tasks * BLOCKS_PER_TASK))))
    side = math.isqrt(block)
    cuts = pairs.filter(F.col("p").cast("double") * F.col("c") > block).select(
        *key,
        F.ceil(F.col("p") / F.least(F.col("p"), F.greatest(F.lit(side), F.lit(block) / F.col("c")))).cast("int").alias("p_cuts"),
        F.ceil(F.col("c") / F.least(F.col("c"), F.greatest(F.lit(side), F.lit(block) / F.col("p")))).cast("int").alias("c_cuts"),
    )
    cuts = checkpointed(cuts)
    return None if cuts.isEmpty() else cuts


def in_blocks(side: DataFrame, cuts: DataFrame, key: list, own: str, other: str) -> DataFrame:
    """The rows of crowded cubes dealt by ``own`` and repeated for every cut of ``other``, as ``own`` and ``other`` numbers."""
    mine = F.pmod(F.xxhash64(*side.columns), F.col(own)).cast("int")
    placed = side.join(cuts, key).withColumn("_mine", mine)
    return placed.withColumn("_other", F.explode(F.expr(f"sequence(0, {other} - 1)"))).select(
        *side.columns, F.col("_mine").alias(own), F.col("_other").alias(other)
    )


def _meet(points: DataFrame, circles: DataFrame, key: list, split: bool) -> DataFrame:
    """Points and circles of the same cube; a cube with many pairs is dealt out in blocks of alike numbers of pairs."""
    if not split:
        return points.join(circles, key)
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = crowded_cubes(points, circles, key, tasks)
    if cuts is None:
        return points.join(circles, key)
    few = F.broadcast(cuts) if cuts.count() <= BROADCAST_CUBES else cuts
    # The explicit count keeps adaptive execution from merging tasks that are small in bytes but heavy in work.
    block = [*key, "p_cuts", "c_cuts"]
    dealt = in_blocks(points, few, key, "p_cuts", "c_cuts").repartition(tasks, *block).join(
        in_blocks(circles, few, key, "c_cuts", "p_cuts").repartition(tasks, *block), block
    ).drop("p_cuts", "c_cuts")
    names = few.select(*key)
    rest = points.join(names, key, "left_anti").join(circles.join(names, key, "left_anti"), key)
    return rest.unionByName(dealt)


def within_circles(points: DataFrame, circles: DataFrame, on: list, levels=LEVELS, split: bool = False) -> DataFrame:
    """Pairs ``distance <= reach`` between points (``p_pos``) and circles (``c_pos``, ``reach``).

    Every pair meets in exactly one cube: a circle lives on one level and lists
    each of its cubes once. The keys spread a crowded group over its cubes; with
    ``split``, for which both sides are written tables, crowded cubes are
    dealt out by their number of pairs.
    """
    points = points.withColumns(dict(zip(("px", "py", "pz"), _axes(F.col("p_pos")))))
    circles = circles.withColumns(dict(zip(("qx", "qy", "qz"), _axes(F.col("c_pos")))))
    straight = sum((F.col("p" + c) - F.col("q" + c)) * (F.col("p" + c) - F.col("q" + c)) for c in "xyz")
    span = F.col("reach") + _SLACK_KM
    return (
        _meet(point_cells(points, "p_pos", levels), circle_cells(circles, "c_pos", "reach"), on + CELL, split)
        # The straight line is cheap and never longer than the distance.
        .filter(straight <= span * span)
        .withColumn("distance", haversine(F.col("c_pos"), F.col("p_pos")))
        .filter(F.col("distance") <= F.col("reach"))
        .drop(*CELL, "px", "py", "pz", "qx", "qy", "qz")
    )
