"""Small helpers shared by the operators of this package."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aidmatch.workspace import checkpointed

#: White space of the contracts; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def saved_with_row_id(df: DataFrame, dense: bool = False) -> DataFrame:
    """Write ``df`` and add ``row_id``, a long that tells its rows apart.

    The id is the place of the row in the written files, so it stays the same
    when a later job or a repeated task reads the table again, and it tells
    identical rows apart. Spark numbers the files of a table by the writing task.
    ``dense`` is that of :func:`checkpointed`.
    """
    table = checkpointed(df, dense)
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    return table.select("*", (part * (1 << 36) + F.col("_metadata.row_index")).alias("row_id"))


def saved_documents(docs: DataFrame) -> DataFrame:
    """``docs`` written as (doc, row_id); ``doc`` holds all columns, so no name of theirs can clash."""
    return saved_with_row_id(docs.select(_whole(docs)))


#: Files up to which a table is numbered by its files; one file takes about 200 bytes of a broadcast.
FILES = 200_000
#: Words of 64 rows each up to which a choice of rows is broadcast, about 60 bytes each.
CHOICE_WORDS = 1 << 20
#: Rows of one key that may meet in a task, and into how many such keys all rows can fall at most.
KEY_ROWS, HOT_KEYS = 4096, 10_000


def _whole(docs: DataFrame) -> Column:
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")


def numbered_documents(docs: DataFrame) -> DataFrame:
    """``docs`` as (doc, row_id) like :func:`saved_documents`, but a table as it is read is not written again.

    Rows of a table are told apart by their file, numbered in the order of the
    paths, and their place in it. Anything else than a plain table is written.
    """
    try:
        files = docs.select(F.col("_metadata.file_path").alias("path")).distinct()
    except AnalysisException:
        return saved_documents(docs)
    if not docs._jdf.queryExecution().analyzed().children().isEmpty():
        return saved_documents(docs)  # a row of a file may stand for several rows here
    files = checkpointed(files)
    if files.count() > FILES:
        return saved_documents(docs)
    # one row per file, FILES at most
    nth = checkpointed(files.select("path", (F.row_number().over(Window.orderBy("path")) - 1).cast("long").alias("nth")))
    placed = docs.select(_whole(docs), F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("place"))
    return placed.join(F.broadcast(nth), "path").select("doc", (F.col("nth") * (1 << 36) + F.col("place")).alias("row_id"))


def rows_times(rows: DataFrame, times: DataFrame, most: int = 1) -> DataFrame:
    """``rows`` (with ``row_id``) as often as ``times`` (row_id, copies) says, ``most`` at most; others go.

    The choice is sent as bits, 64 rows of a file to a word, where that is small
    enough to be broadcast; beyond, the rows are shuffled to the choice.
    """
    bit = F.expr("shiftleft(1L, CAST(row_id & 63 AS INT))")
    word = F.shiftright("row_id", 6).alias("_word")
    chosen = checkpointed(times.groupBy(word).agg(*(
        F.coalesce(F.bit_or(F.when(F.col("copies") >= k, bit)), F.lit(0)).cast("bigint").alias(f"_bits{k}") for k in range(1, most + 1)
    )))
    if chosen.count() <= CHOICE_WORDS:
        chosen = F.broadcast(chosen)
    else:
        chosen = chosen.hint("shuffle_hash")
    held = rows.withColumn("_word", F.shiftright("row_id", 6)).join(chosen, "_word")
    copies = sum(F.getbit(f"_bits{k}", F.expr("CAST(row_id & 63 AS INT)")).cast("int") for k in range(1, most + 1))
    if most == 1:
        return held.filter(copies == 1).select(*rows.columns)
    held = held.withColumn("_copies", copies).filter("_copies > 0")
    return held.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(*rows.columns)


def join_unique(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, which has one row for a key at most; ``left`` is a written table.

    Keys that many rows of ``left`` share are joined by a broadcast of their rows
    of ``right``: no more than ``HOT_KEYS`` keys can have a ``HOT_KEYS``-th of all
    rows each. Rows without a key are left aside.
    """
    alone = left.filter(F.col(key).isNull())
    left = left.filter(F.col(key).isNotNull())
    many = max(KEY_ROWS, -(-left.count() // HOT_KEYS))
    hot = checkpointed(left.groupBy(key).agg(F.count("*").alias("_many")).filter(F.col("_many") > many).select(key))
    if hot.isEmpty():
        out = left.join(right, key, how)
    else:
        hot = F.broadcast(hot)
        few = checkpointed(right.join(hot, key, "left_semi"))
        out = left.join(hot, key, "left_anti").join(right, key, how).unionByName(
            left.join(hot, key, "left_semi").join(F.broadcast(few), key, how)
        )
    return out.unionByName(alone, allowMissingColumns=True) if how == "left" else out


def parts_for(spark: SparkSession, rows: int, per_part: int) -> int:
    """How many partitions to deal ``rows`` to, no fewer than a shuffle has."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_part))
