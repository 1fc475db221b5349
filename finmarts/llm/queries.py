"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from finmarts.llm import byte_repeats
from finmarts.llm.ann import nearest
from finmarts.llm.common import table
from finmarts.llm.encoding import tokenizer_path
from finmarts.llm.mixing import digest_per_document
from finmarts.llm.oracles import ORACLE_SQL  # noqa: F401
from finmarts.llm.packing import pack_documents
from finmarts.llm.quality import BASE, quality
from finmarts.llm.ranked_search import best_documents
from finmarts.llm.resampling import importance_ranks
from finmarts.llm.simhash import components
from finmarts.llm.suffix_tree import language_scores
from finmarts.llm.superkmers import without_repeats
from finmarts.llm.token_files import read_token_files, write_token_files
from finmarts.llm.toxicity import toxicity
from finmarts.llm.wrappers import main_text

END_ID = 2


def op1_weak_supervision_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_bit_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_token_files(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), END_ID)
    return read_token_files(manifest, with_ids=False)


def op3_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op5_line_frequency_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).select("doc_id", *BASE, "base_failed", "kept", "n_removed_words")


def op6_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))


def op7_splitting_tree_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_per_document(table(spark, sf_dir, "documents"))


def op8_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), END_ID)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(table(spark, sf_dir, "documents"))
    hexed = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op10_super_kmer_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = without_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_linear_grouping_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = byte_repeats.without_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_k2_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_weak_supervision_toxicity": op1_weak_supervision_toxicity,
    "op2_bit_packed_tokens": op2_bit_packed_tokens,
    "op3_multi_index_hashing": op3_multi_index_hashing,
    "op4_wrapper_induction": op4_wrapper_induction,
    "op5_line_frequency_quality": op5_line_frequency_quality,
    "op6_suffix_tree_scores": op6_suffix_tree_scores,
    "op7_splitting_tree_mix": op7_splitting_tree_mix,
    "op8_cost_balanced_packing": op8_cost_balanced_packing,
    "op9_covering_simhash": op9_covering_simhash,
    "op10_super_kmer_substrings": op10_super_kmer_substrings,
    "op11_linear_grouping_dedup": op11_linear_grouping_dedup,
    "op12_k2_treap_search": op12_k2_treap_search,
    "op13_importance_resampling": op13_importance_resampling,
}
