"""Where iterative jobs cut their lineage."""

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@lru_cache
def _local_dir(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="aidmatch-")


def _shared_dir(spark: SparkSession) -> str:
    """The folder the session names, or a temporary one where Spark runs on this machine only."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return f"{configured.rstrip('/')}/{context.applicationId}"
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir(context.applicationId)


_scopes = threading.local()


#: Whether Spark removes the shuffles of an execution when that ends; else they stay until the driver's memory is cleaned.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows go to Python in batches of so many bytes at most; several batches of a task are held at once, on both sides.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20)


def checkpointed(df: DataFrame, dense: bool = False) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from the table.

    A lost executor costs no replay of the loop, readers take only the columns
    they need, and the planner knows the size. Each task writes one file, so the
    name of a file and the place in it tell rows apart. Tables stay until their
    :func:`scratch` block ends, or else until the folder of the application is
    removed. Python tasks get batches of bounded size. ``dense`` is for large tables: it packs them more tightly at the price
    of some CPU time, and the shuffles they came from go as soon as they are written.
    """
    return _written(df, _open()[-1] if _open() else None, dense)


def checkpointed_in_order(df: DataFrame, name: str) -> DataFrame:
    """Write a sorted ``df`` and add ``name``, a long that rises in its order and is the same for every reader.

    The tasks of a sort write one file each, numbered in the order of the ranges.
    """
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    return checkpointed(df).select("*", (part * (1 << 36) + F.col("_metadata.row_index")).alias(name))


def _open() -> list[list[str]]:
    """The paths of each block that is open in this thread, the innermost last."""
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    return _scopes.open


def scratch_path(spark: SparkSession) -> str:
    """A path in the checkpoint folder that nothing uses."""
    return f"{_shared_dir(spark)}/{uuid.uuid4().hex}"


def _written(df: DataFrame, owner: list[str] | None, dense: bool = False) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark)
    if owner is not None:
        owner.append(path)
    write = df.write.option("maxRecordsPerFile", 0)
    options = dict([_BATCH_BYTES])
    if dense:
        options[_CLEANUP] = "true"
        write.option("compression", "zstd")
    with _set(spark, options):
        write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _set(spark: SparkSession, options: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in options}
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Remove the tables that :func:`checkpointed` writes inside the block when it ends.

    What the block has found goes through the function that it is given, which
    writes a table that outlives the block; no other DataFrame made inside may
    be read after it.
    """
    outer = _open()[-1] if _open() else None
    mine: list[str] = []
    _open().append(mine)
    try:
        yield lambda df: _written(df, outer)
    finally:
        _open().pop()
        for name in mine:
            _remove(spark, name)


def discard(df: DataFrame) -> None:
    """Remove a table of :func:`checkpointed` that no DataFrame reads any more, before its block ends."""
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        _remove(df.sparkSession, folder)


def _remove(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
