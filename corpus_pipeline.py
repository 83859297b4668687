"""A corpus in stages: what one stage keeps is written as Parquet and read again by the next."""

from pyspark.sql import DataFrame, SparkSession

from aidmatch.llm.common import documents
from aidmatch.llm.cuckoo_dedup import drop_copies
from aidmatch.llm.packing import pack_documents
from aidmatch.llm.pareto_mix import repeat_by_mix
from aidmatch.llm.parity_join import keep_one
from aidmatch.llm.queries import vocabulary
from aidmatch.llm.weak_toxicity import drop_toxic
from aidmatch.workspace import checkpointed


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return repeat_by_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return pack_documents(docs, *vocabulary())


STAGES = [
    ("toxicity", toxicity), ("exact dedup", exact_copies), ("near duplicates", near_copies), ("mixture", mixture), ("packing", packing),
]

#: A trained classifier's scores and a tokenizer's ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; all but the last are written and read again."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
