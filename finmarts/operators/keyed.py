"""Keep-latest tables held in hash buckets of their key, of which a refresh rewrites only those it reaches.

A store keeps the newest row of each key with its version columns. Arrivals are merged with the buckets that hold their
keys; the other buckets keep their files, so what a refresh costs depends on what has arrived and not on the table. The
number of buckets is fixed by the first build.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from finmarts.operators.latest import LOAD_ORDER, latest
from finmarts.sources import versions

BUCKET = "bucket"
#: Rows that a bucket is to hold, and the most buckets there are.
BUCKET_ROWS, MOST_BUCKETS = 100_000, 4096
LEAST_BUCKETS = 8


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows with their bucket, laid out so that a bucket is written by few tasks and in order of the key."""
    keyed = df.withColumn(BUCKET, bucket_of(key, buckets))
    return keyed.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, key)


def merge_arrivals(
    arrivals: DataFrame, path: str, key: str, order: Sequence[str] = LOAD_ORDER, bucket_rows: int = BUCKET_ROWS
) -> versions.Manifest:
    """Bring the store at ``path`` to the newest row of each key; the state in force afterwards.

    On equal versions the arriving row wins. Deleted rows (``_is_deleted`` other than 0) are dropped first, as in the
    clean layer. The newest value of the first version column is noted, for `unseen`.
    """
    spark = arrivals.sparkSession
    base = versions.manifest(spark, path)
    live = arrivals.where(F.col("_is_deleted") == 0) if "_is_deleted" in arrivals.columns else arrivals
    newest = arrivals.agg(F.max(order[0]).cast("string").alias("newest"), F.count(F.lit(1)).alias("n")).first()
    if base is None:
        buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-newest.n // bucket_rows)))
        marks = {"buckets": str(buckets)} | ({"newest": newest.newest} if newest.newest else {})
        return versions.replace(bucketed(latest(live, [key], order), key, buckets), path, BUCKET, marks=marks)
    buckets = int(base.marks["buckets"])
    # at most MOST_BUCKETS numbers
    reached = [r[0] for r in live.select(bucket_of(key, buckets)).distinct().collect()]
    seen = max(base.marks.get("newest", ""), newest.newest or "")
    if not reached:
        return base
    stored = versions.at_partitions(versions.read(spark, path, base), BUCKET, reached).drop(BUCKET)
    both = stored.withColumn("_side", F.lit(0)).unionByName(live.select(*stored.columns).withColumn("_side", F.lit(1)))
    merged = bucketed(latest(both, [key], [*order, "_side"]).drop("_side"), key, buckets)
    return versions.replace_partitions(merged, path, reached, base, marks=dict(base.marks) | {"newest": seen})


def unseen(source: DataFrame, state: versions.Manifest | None, first_version: str = LOAD_ORDER[0]) -> DataFrame:
    """Source rows that may be newer than the store: from the newest version seen on, as that day may not be over."""
    if state is None or "newest" not in state.marks:
        return source
    kind = source.schema[first_version].dataType
    return source.where(F.col(first_version) >= F.lit(state.marks["newest"]).cast(kind))


def stored_rows(spark: SparkSession, path: str, state: versions.Manifest | None = None) -> DataFrame:
    """The rows of a store, with their bucket."""
    return versions.read(spark, path, state)
