"""Connected components of an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidmatch.workspace import checkpointed


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); the component is its smallest node.

    Stars over larger and then over smaller neighbours, in turns, until nothing
    changes. Every turn is written, so a lost executor repeats one turn only;
    the driver sees two numbers a turn.
    """
    both = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = checkpointed(both), None
    while True:
        ways = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = ways.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        # every larger neighbour points to the smallest node around
        large = ways.join(low, "a").filter("b > a AND b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = checkpointed(large)
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        # every smaller neighbour, and the node itself, points to the smallest of them
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")
        ).select("e.a", "e.b").filter("a <> b").distinct()
        now = checkpointed(small)
        after = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if after == before:
            break
        before = after
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return checkpointed(nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
