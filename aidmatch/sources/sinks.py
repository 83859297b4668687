"""Match events and returned records on shared storage."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def publish(df: DataFrame, batch_id: int, fmt: str = "parquet", path: str = None, **options) -> None:
    """Send ``value`` rows to a topic, or (with ``ts``) to a folder that a stream reads.

    The folder of a batch is replaced when the batch is written again. A topic
    gets its messages at least once; match ids let a reader drop repeats.
    """
    if fmt == "kafka":
        df.select("value").write.format("kafka").options(**options).save()
    else:
        df.select("value", F.col("ts").cast("timestamp").alias("ts")).write.mode("overwrite").format(fmt).save(
            f"{path}/published-{batch_id}"
        )
