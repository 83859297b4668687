"""Distance joins over crowded places."""

import random
from statistics import median

from pyspark.sql import functions as F

from aidmatch.functions import grid
from aidmatch.functions.geo import position
from aidmatch.operators.proximity import nearest_volunteer, reachable
from aidmatch.workspace import checkpointed
from tests.rows import frame, km, need, offer


def crowd(seed, helps, offers, span):
    rng = random.Random(seed)

    def spot():
        return dict(lat=39.3 + rng.randrange(span) / 1e4, lon=-0.5 + rng.randrange(span) / 1e4)

    return [need(f"h{i}", at=i % 50, **spot()) for i in range(helps)] + [
        offer(f"v{i}", radius=rng.choice([0, 1, 5, 20, None]), at=i % 50, **spot()) for i in range(offers)
    ]


def by_hand(rows):
    near, reach = {}, {}
    for h in (r for r in rows if r["is_help"]):
        found = sorted(
            (round(km(h, v), 9), v["ts"], v["id"]) for v in rows
            if not v["is_help"] and v["radio_disponible_km"] is not None and km(h, v) <= v["radio_disponible_km"]
        )
        if found:
            near[h["id"]] = found[0][2]
            reach[h["id"]] = (len(found), round(found[0][0], 6), round(found[-1][0], 6))
    return near, reach


def test_large_groups_equal_all_pairs(spark):
    for seed, helps, offers, span in ((1, 60, 80, 2000), (2, 50, 60, 1), (3, 40, 5, 9000)):
        rows = crowd(seed, helps, offers, span)
        near, reach = by_hand(rows)
        df = frame(spark, rows)
        for bounds in ({}, {"max_rows": 0}):
            assert {r.help_id: r.volunteer_id for r in nearest_volunteer(df, **bounds).collect()} == near
            got = {r.help_id: (r.eligible, round(r.nearest, 6), round(r.farthest, 6)) for r in reachable(df, **bounds).collect()}
            assert got == reach


def test_nearest_of_one_address(spark):
    """A crowded cube in default bounds: requests of one place are one search, volunteers alike are one seat."""
    rows = [need(f"h{i}", at=i % 60) for i in range(3000)] + [offer(f"v{i:04}", radius=5, at=59 - i % 60) for i in range(3000)]
    found = nearest_volunteer(frame(spark, rows)).groupBy("volunteer_id", "distance").count().collect()
    assert [(r.volunteer_id, r.distance, r["count"]) for r in found] == [("v0059", 0.0, 3000)]


def test_a_crowded_cube_is_dealt_evenly(spark):
    at = position(F.lit(39.4) + F.col("id") / 1e7, F.lit(-0.4))
    points = checkpointed(spark.range(3000).select(F.lit("x").alias("g"), F.col("id").alias("p"), at.alias("p_pos")))
    circles = checkpointed(spark.range(2500).select(F.lit("x").alias("g"), F.col("id").alias("c"), at.alias("c_pos"), F.lit(5.0).alias("reach")))
    pairs = grid.within_circles(points, circles, ["g"], [row[0] for row in circles.select(grid.level_for(F.col("reach"))).distinct().collect()], split=True)
    per_task = [r["n"] for r in pairs.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()]
    assert sum(per_task) == 3000 * 2500 and len(per_task) == 8
    assert max(per_task) <= 2 * median(per_task)
    assert pairs.select("p", "c").distinct().count() == 3000 * 2500
