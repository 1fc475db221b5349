"""The queries that SQL can express, against DuckDB."""

import os
import compare
import duckdb
import odd
import pyarrow as pa
import pytest
from finmarts.llm.mixing import digest_per_document
from finmarts.llm.oracles import ORACLE_SQL
from finmarts.llm.quality import BASE, quality
from finmarts.llm.queries import QUERIES
from finmarts.llm.superkmers import without_repeats
from pyspark.sql import functions as F

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

OPERATORS = {
    "op5_line_frequency_quality": lambda d: quality(d).select("doc_id", *BASE, "base_failed", "kept", "n_removed_words"),
    "op7_splitting_tree_mix": digest_per_document,
    "op10_super_kmer_substrings": lambda d: without_repeats(d).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    ),
}


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query(name, spark):
    con = duckdb.connect()
    for name_ in ("documents", "benchmark"):
        con.execute(f"create view {name_} as select * from '{SF}/{name_}.parquet'")
    assert compare.differences(QUERIES[name](spark, SF), con, ORACLE_SQL[name]) == []


@pytest.mark.parametrize("name", list(OPERATORS))
@pytest.mark.parametrize("some", ["odd", "empty"])
def test_odd_documents(name, some, spark):
    rows = odd.rows() if some == "odd" else []
    con = duckdb.connect()
    columns = dict(zip(["doc_id", "text", "lang", "source"], zip(*rows) if rows else [[]] * 4))
    kinds = {"doc_id": pa.int64()}
    documents = pa.table({k: pa.array(list(v), kinds.get(k, pa.string())) for k, v in columns.items()})
    con.register("documents", documents)
    assert compare.differences(OPERATORS[name](odd.documents(spark, rows)), con, ORACLE_SQL[name]) == []


def test_crowded_buckets_give_the_same_removals(spark):
    plain = without_repeats(odd.documents(spark)).select("doc_id", "text_hash", "n_removed")
    split = without_repeats(odd.documents(spark), hot=1, hot_strings=1).select("doc_id", "text_hash", "n_removed")
    assert sorted(plain.collect(), key=repr) == sorted(split.collect(), key=repr)
