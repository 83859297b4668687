"""The operators of this package as queries over whole test tables, with SQL where it can say the same."""

from pyspark.sql import functions as F

from aidmatch.llm.collocations import COLLOCATION_SQL, collocations
from aidmatch.llm.common import documents
from aidmatch.llm.crf_pii import find_personal_data
from aidmatch.llm.cuckoo_dedup import exact_dedup
from aidmatch.llm.merkle import MANIFEST_SQL, audited
from aidmatch.llm.mincut_html import extract_text
from aidmatch.llm.minhash import minhash_duplicates
from aidmatch.llm.packing import pack_documents
from aidmatch.llm.pareto_mix import MIX_SQL, mix
from aidmatch.llm.parity_join import near_duplicates
from aidmatch.llm.ring_shards import shard_rows
from aidmatch.llm.secrets import scan_secrets
from aidmatch.llm.stable_ann import nearest
from aidmatch.llm.weak_toxicity import score_toxicity


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_sum_of_squares_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir), *vocabulary())


def op2_parity_sketch_join(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir)).drop("set_id")


def op3_min_cut_html(spark, sf_dir):
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_weak_toxicity(spark, sf_dir):
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_stable_projections(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(rows, rows.filter("vec_id % 20 = 0"))


def op6_linked_secrets(spark, sf_dir):
    return scan_secrets(documents(spark, sf_dir))


def op7_pareto_mix(spark, sf_dir):
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op8_ring_shards(spark, sf_dir):
    return shard_rows(documents(spark, sf_dir), shards=24)


def op9_cuckoo_dedup(spark, sf_dir):
    return exact_dedup(documents(spark, sf_dir))


def op10_crf_personal_data(spark, sf_dir):
    return find_personal_data(documents(spark, sf_dir))


def op11_setm_collocations(spark, sf_dir):
    return collocations(documents(spark, sf_dir))


def op12_merkle_manifest(spark, sf_dir):
    return audited(documents(spark, sf_dir))


def op13_minhash_dedup(spark, sf_dir):
    return minhash_duplicates(documents(spark, sf_dir))


DEDUP_SQL = r"""
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
WINDOW g AS (PARTITION BY text_sha256)
"""

QUERIES = {f.__name__: f for f in (
    op1_sum_of_squares_packing, op2_parity_sketch_join, op3_min_cut_html, op4_weak_toxicity, op5_stable_projections,
    op6_linked_secrets, op7_pareto_mix, op8_ring_shards, op9_cuckoo_dedup, op10_crf_personal_data, op11_setm_collocations,
    op12_merkle_manifest, op13_minhash_dedup,
)}
SQL = {
    "op7_pareto_mix": MIX_SQL, "op9_cuckoo_dedup": DEDUP_SQL, "op11_setm_collocations": COLLOCATION_SQL,
    "op12_merkle_manifest": MANIFEST_SQL,
}
