"""A training corpus from raw documents: quality rules, near-dedup, substring dedup, mixing and packing.

Every stage takes what its predecessor kept, as a table with the columns of documents, and its decisions take effect:
rejected documents and frequent lines go, one document of each near-duplicate group stays, repeated passages are
taken out, documents are taken as often and as far as their source's target asks. The last stage gives the packed
pieces. `run` writes each stage to the shared folder and reads it again, so that a lost executor repeats tasks of one
stage only.

Stages give a row a defined result whatever it holds: a null or blank text fails the quality rules, null ids and
sources are values of their own, of repeated rows near-dedup keeps one, an empty table passes through empty, and extra
columns pass through unchanged, even those with names that the stages use inside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from finmarts.llm import mixing, packing, quality, simhash, superkmers
from finmarts.llm.common import table, written
from finmarts.llm.encoding import tokenizer_path

END_ID = 2
#: A document needs a passage of more words than this from elsewhere before the passage is taken out.
REPEAT_WINDOW = 35


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that their host repeats."""
    return quality.cleaned(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates: fingerprints of three-word shingles, three bits."""
    return simhash.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand elsewhere too; documents that lose no word keep their text as it is."""
    return superkmers.removed_from(docs, REPEAT_WINDOW)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mix as documents: a row for each pass that takes a document, the last cut to its target."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all packed sequences."""
    pieces = packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), END_ID)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: SQL can't express the stages' hashes, tokenizer and groupings; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
