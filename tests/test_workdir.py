"""Statements that write a table leave no shuffle files behind."""

import os
import time

import pytest
from pyspark.sql import functions as F

from finmarts.llm.byte_repeats import without_repeats
from finmarts.llm.common import written
from finmarts.sources import versions
from finmarts.sources.workdir import RELEASE, shuffles_released


def shuffle_files(spark):
    roots = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for root in roots for _, _, found in os.walk(root) for f in found if f.startswith("shuffle_")}


def left_by(spark, write):
    before = shuffle_files(spark)
    write(spark.range(20_000).repartition(7, F.col("id") % 11).groupBy((F.col("id") % 13).alias("k")).count())
    for _ in range(50):  # deleted behind the statement's back
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_writes_leave_no_shuffles(spark, tmp_path):
    assert not left_by(spark, lambda df: written(df, "test-shuffles"))
    assert not left_by(spark, lambda df: versions.replace(df, str(tmp_path / "table")))
    assert versions.read(spark, str(tmp_path / "table")).count() == 13


def test_the_setting_is_put_back(spark):
    assert spark.conf.get(RELEASE, None) is None
    with shuffles_released(spark):
        assert spark.conf.get(RELEASE) == "true"
    assert spark.conf.get(RELEASE, None) is None
    spark.conf.set(RELEASE, "false")
    with pytest.raises(RuntimeError), shuffles_released(spark):
        raise RuntimeError
    assert spark.conf.get(RELEASE) == "false"
    spark.conf.unset(RELEASE)


def test_a_plan_runs_again(spark, tmp_path):
    df = spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count()
    first = sorted(tuple(r) for r in df.collect())
    versions.replace(df, str(tmp_path / "again"))
    assert sorted(tuple(r) for r in df.collect()) == first
    assert sorted(tuple(r) for r in versions.read(spark, str(tmp_path / "again")).select("k", "count").collect()) == first


def test_texts_move_when_the_shuffles_that_found_repeats_are_gone(spark):
    text = "".join(f"{i:04d}" for i in range(100))
    docs = spark.createDataFrame([(1, text), (2, "x" + text[:80] + "y"), (3, None)], "doc_id long, text string")
    left = without_repeats(docs)
    assert "minimiser" not in left._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in left.collect()) == [(1, 400, 0, 0), (2, 82, 80, 1), (3, 0, 0, 0)]
