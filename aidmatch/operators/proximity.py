"""Distance joins that are not exclusive: who could serve a request, and who is nearest."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidmatch.functions.geo import haversine, may_reach, position
from aidmatch.functions.grid import LEVELS, level_for, reach_of, within_circles
from aidmatch.operators.assignment import MAX_GROUP_PAIRS, MAX_GROUP_ROWS, split_by_size
from aidmatch.operators.coverage import coverage
from aidmatch.operators.windows import GROUP
from aidmatch.workspace import checkpointed, checkpointed_in_order

# Pairs of a group that are simply compared when only the nearest counts.
NEAREST_PAIRS = 1 << 14


def _levels(df: DataFrame, radius: str) -> list[int]:
    """The levels of circles in use, no more than the grid has."""
    return [row[0] for row in df.select(level_for(F.col(radius))).distinct().collect()] or LEVELS[:1]


def _bounded_pairs(df: DataFrame) -> DataFrame:
    helps, volunteers = _sides(df)
    return (
        helps.join(volunteers, GROUP)
        .filter(may_reach(F.col("p_pos"), F.col("c_pos"), F.col("reach")))
        .withColumn("distance", haversine(F.col("c_pos"), F.col("p_pos")))
        .filter(F.col("distance") <= F.col("reach"))
        .select(*GROUP, "help_id", "volunteer_id", "v_ts", "distance")
    )


def _sides(df: DataFrame):
    pos = position(F.col("lat"), F.col("lon"))
    helps = df.filter("is_help").select(*GROUP, F.col("id").alias("help_id"), pos.alias("p_pos"))
    volunteers = df.filter("NOT is_help AND radio_disponible_km >= 0").select(
        *GROUP,
        F.col("id").alias("volunteer_id"),
        F.col("ts").alias("v_ts"),
        pos.alias("c_pos"),
        F.col("radio_disponible_km").cast("double").alias("reach"),
    )
    return helps, volunteers


def nearest_volunteer(df: DataFrame, max_rows: int = MAX_GROUP_ROWS, max_pairs: int = NEAREST_PAIRS) -> DataFrame:
    """Per request the nearest volunteer whose radius covers it; arrival and id break ties.

    Small groups compare all their pairs. In larger ones each place looks only as
    far as it needs to: a search widens from the finest cube to the first that
    surely holds somebody whose circle spans it.
    """
    bounded, large = split_by_size(df, max_rows, max_pairs)
    best = F.min(F.struct("distance", "v_ts", "volunteer_id")).alias("best")
    out = _bounded_pairs(bounded).groupBy(*GROUP, "help_id").agg(best)
    if large is not None:
        out = out.unionByName(_nearest_of_many(large, best).select(*out.columns))
    return out.select(*GROUP, "help_id", "best.volunteer_id", "best.distance")


def _nearest_of_many(df: DataFrame, best) -> DataFrame:
    helps, volunteers = _sides(df)
    helps = checkpointed(helps)
    # requests of one place have one answer, and of volunteers alike the first serves
    places = helps.select(*GROUP, F.col("p_pos").alias("pos")).distinct()
    first = F.min(F.struct("v_ts", "volunteer_id")).alias("first")
    seats = checkpointed(volunteers.groupBy(*GROUP, F.col("c_pos").alias("pos"), F.col("reach").alias("radius")).agg(first))
    widest = seats.agg(F.max("radius")).first()[0]
    if widest is None:
        return helps.limit(0).select(*GROUP, "help_id", F.lit(None).cast(
            f"struct<distance:double,v_ts:{volunteers.schema['v_ts'].dataType.simpleString()},volunteer_id:string>"
        ).alias("best"))
    circles = checkpointed(reach_of(places, seats, GROUP, 1, widest).withColumnRenamed("pos", "c_pos"))
    found = (
        within_circles(seats.withColumnRenamed("pos", "p_pos"), circles, GROUP, _levels(circles, "reach"), split=True)
        .filter(F.col("distance") <= F.col("radius"))
        .select(*GROUP, F.col("c_pos").alias("p_pos"), "distance", "first.v_ts", "first.volunteer_id")
        .groupBy(*GROUP, "p_pos").agg(best)
    )
    return helps.join(found, [*GROUP, "p_pos"]).groupBy(*GROUP, "help_id").agg(F.min("best").alias("best"))


def reachable(df: DataFrame, max_rows: int = MAX_GROUP_ROWS, max_pairs: int = MAX_GROUP_PAIRS) -> DataFrame:
    """Per request how many volunteers cover it, and how near and far they are.

    Groups of bounded size compare their pairs; larger ones count circles for
    whole neighbourhoods, see :mod:`aidmatch.operators.coverage`.
    """
    bounded, large = split_by_size(df, max_rows, max_pairs)
    counted = [F.sum("eligible").alias("eligible"), F.min("nearest").alias("nearest"), F.max("farthest").alias("farthest")]
    out = _bounded_pairs(bounded).select(
        *GROUP, "help_id", F.lit(1).cast("bigint").alias("eligible"), F.col("distance").alias("nearest"), F.col("distance").alias("farthest")
    )
    if large is not None:
        helps, volunteers = _sides(large)
        # numbers that every reader of the table sees alike
        helps = checkpointed_in_order(helps.sort(*GROUP), "point")
        volunteers = checkpointed(volunteers.select(*GROUP, "c_pos", "reach"))
        covered = coverage(helps.select(*GROUP, "point", "p_pos"), volunteers, GROUP, _levels(volunteers, "reach"))
        covered = covered.groupBy("point").agg(*counted)
        out = out.unionByName(helps.join(covered, "point").select(*out.columns))
    return out.groupBy(*GROUP, "help_id").agg(*counted)
