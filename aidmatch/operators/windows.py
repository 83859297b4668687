"""Event-time windows, repeats, and the two sides of a group."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidmatch.schemas import PAYLOAD, WINDOW_LENGTH

GROUP = ["w", "categoria"]


def tumbling(df: DataFrame, length: str = WINDOW_LENGTH) -> DataFrame:
    """Add ``w``, the start of the fixed window that holds ``ts``."""
    return df.withColumn("w", F.window("ts", length)["start"])


def dedupe(df: DataFrame) -> DataFrame:
    """One row per distinct record of a window; the earliest arrival stays.

    Two records with one ``id`` but any other difference both survive. Copies
    collapse before the shuffle, whose key is the whole record.
    """
    keys = ["w", "is_help", *PAYLOAD, "lat", "lon"]
    return df.groupBy(*keys).agg(F.min("ts").alias("ts"))


def group_sizes(df: DataFrame) -> DataFrame:
    """Requests and offers per group; a side without any counts 0."""
    return df.groupBy(*GROUP).agg(
        F.count_if(F.col("is_help")).alias("helps"),
        F.count_if(~F.col("is_help")).alias("volunteers"),
    )


def window_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("w").agg(
        F.count_if(F.col("is_help")).alias("helps"),
        F.count_if(~F.col("is_help")).alias("volunteers"),
    )
