"""Connected parts of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidmatch.workspace import checkpointed, scratch


def connected_parts(links: DataFrame) -> DataFrame:
    """(node, part) of every node of ``links`` (a, b); a part is named by its smallest node.

    Every node points to the smallest node that it knows. In a turn it learns
    what its neighbours point to, and then what its own goal points to, so paths
    get shorter by half and the number of turns grows with their logarithm. Each
    turn is written; the driver sees one number.
    """
    spark = links.sparkSession
    with scratch(spark) as keep_all:
        ways = checkpointed(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
        goals = checkpointed(ways.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("part")))
        while True:
            near = ways.join(goals, F.col("b") == F.col("node")).groupBy("a").agg(F.min("part").alias("near"))
            # the goal of a node learns as well, or it would hold back all that point to it
            told = goals.join(near, F.col("node") == F.col("a")).select("node", F.col("part").alias("was"), F.least("part", "near").alias("now"))
            told = checkpointed(told)
            hooked = told.groupBy(F.col("was").alias("node")).agg(F.min("now").alias("hook"))
            with_hook = told.join(hooked, "node", "left").select("node", "was", F.least("now", F.coalesce("hook", "now")).alias("now"))
            step = checkpointed(with_hook)
            jump = step.select(F.col("node").alias("goal"), F.col("now").alias("jump"))
            after = checkpointed(step.join(jump, F.col("now") == F.col("goal"), "left").select(
                "node", "was", F.least("now", F.coalesce("jump", "now")).alias("part")
            ))
            changed = after.filter("part <> was").limit(1).count()
            goals = after.select("node", "part")
            if not changed:
                return keep_all(goals)
