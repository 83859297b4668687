"""Summary queries over the three result tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def _totals(matched: DataFrame, requests: DataFrame, volunteers: DataFrame) -> DataFrame:
    """Three counts as one row: the sides of the joins are aggregates of exactly one row."""
    return (
        _count(matched).withColumnRenamed("total", "matched")
        .crossJoin(_count(requests).withColumnRenamed("total", "requests"))
        .crossJoin(_count(volunteers).withColumnRenamed("total", "volunteers"))
    )


def total_messages(matched, requests, volunteers) -> DataFrame:
    """Finished records: a match is made of two."""
    total = F.col("requests") + F.col("volunteers") + 2 * F.col("matched")
    return _totals(matched, requests, volunteers).select(total.alias("total_messages"))


def match_totals(matched, requests, volunteers) -> DataFrame:
    return _totals(matched, requests, volunteers).select(
        F.col("matched").alias("total_matches"), (F.col("requests") + F.col("volunteers")).alias("total_not_matched")
    )


def _by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("total")).orderBy(F.desc("total"), column)


def matches_by_location(matched) -> DataFrame:
    return _by(matched, "help_poblacion")


def matches_by_category(matched) -> DataFrame:
    return _by(matched, "categoria")


def unmatched_by_location(requests) -> DataFrame:
    return _by(requests, "poblacion")


def unmatched_by_category(requests) -> DataFrame:
    return _by(requests, "categoria")


def avg_urgency_by_category(matched, requests) -> DataFrame:
    """Mean over the distinct urgencies of each table, not weighted by rows."""
    levels = (
        requests.groupBy("categoria", F.col("nivel_urgencia").alias("urgencia")).agg(F.count("*").alias("total"))
        .unionByName(matched.groupBy("categoria", "urgencia").agg(F.count("*").alias("total")))
    )
    return (
        levels.groupBy("categoria")
        .agg(F.avg("urgencia").alias("urgencia_promedio"))
        .orderBy(F.desc("urgencia_promedio"), "categoria")
    )


def category_demand(matched, requests, volunteers) -> DataFrame:
    """Requested and offered records per category, over the finished ones."""
    one, none = F.lit(1), F.lit(0)
    sides = (
        matched.select("categoria", one.alias("asked"), one.alias("gave"))
        .unionAll(requests.select("categoria", one, none))
        .unionAll(volunteers.select("categoria", none, one))
    )
    return sides.groupBy("categoria").agg(F.sum("asked").alias("requested"), F.sum("gave").alias("offered"))
