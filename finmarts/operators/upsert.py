"""Incremental upsert of month-partitioned fact tables.

An upsert writes the new content of the months it touches into a folder of its own and then puts it in force by adding
a manifest (`finmarts.sources.versions`). Until then readers see the old table, from then on the new one; a run that
dies changes nothing, and the next starts from the table as it is.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from finmarts.operators.latest import latest
from finmarts.sources import files, versions
from finmarts.sources.sinks import MONTH, PARTITION_BY, arranged
from finmarts.sources.workdir import shuffles_released

LOOKBACK_DAYS = 3


def recent_rows(source: DataFrame, newest: dt.date | None, date: str | None, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """Source rows from the lookback window on and those without a date; all of them if the target is empty.

    The bound is a literal. Where the source keeps a month column of its files, it is bounded too, so that only
    those months' folders are read. A source without a date of its own (None) is bounded by month alone.
    """
    if newest is None:
        return source
    bound = F.lit(newest - dt.timedelta(days=lookback))
    rows = source.where((F.col(date) >= bound) | F.col(date).isNull()) if date else source
    if MONTH in source.columns:
        month = F.col(MONTH)
        rows = rows.where((month >= PARTITION_BY[MONTH](bound)) | (month == PARTITION_BY[MONTH](F.lit(None).cast("date"))))
    return rows


def merge_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, plus the batch."""
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(batch)


def newest_date(table: DataFrame, date: str) -> dt.date | None:
    """Latest date of a month-partitioned table, read from its last non-empty month only.

    The month column is a folder name, so finding it reads no data columns.
    """
    last_month = table.agg(F.max(MONTH).alias("m")).first().m
    if last_month is None:
        return None
    return table.where(F.col(MONTH) == last_month).agg(F.max(date).alias("d")).first().d


def upsert_table(
    source: DataFrame,
    path: str,
    key: str,
    date: str,
    sort: Sequence[str] = (),
    lookback: int | None = LOOKBACK_DAYS,
    version: Sequence[str] = (),
) -> versions.Manifest:
    """Delete-and-insert by key into the month-partitioned table at ``path``; the state that is in force afterwards.

    Only months that hold a batch key or receive a batch row are rewritten; a key may have moved to another month.
    Rows without a date are always part of the batch and lie in a month of their own. ``lookback`` None takes every
    row of ``source``. With ``version`` columns a stored row stays unless the batch's is as new or newer.
    """
    spark = source.sparkSession
    base = versions.manifest(spark, path)
    source = source.drop(MONTH) if lookback is None else source
    if base is None:
        return versions.replace(arranged(source.drop(MONTH), date, sort), path, MONTH)
    target = versions.read(spark, path, base)
    rows = source if lookback is None else recent_rows(source, newest_date(target, date), date, lookback)
    staged = f"{path}/_batch-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        rows.drop(MONTH).write.parquet(staged, compression=versions.CODEC)
    try:
        batch = spark.read.schema(source.drop(MONTH).schema).parquet(staged)
        received = batch.select(PARTITION_BY[MONTH](F.col(date)).alias(MONTH))
        holding = target.join(batch.select(key), key, "left_semi").select(MONTH)
        # bounded by the number of calendar months
        months = sorted(r[MONTH] for r in received.union(holding).distinct().collect())
        if not months:
            return base
        affected = versions.at_partitions(target, MONTH, months).drop(MONTH)
        incoming = batch.select(*affected.columns)
        if version:
            both = affected.withColumn("_side", F.lit(0)).unionByName(incoming.withColumn("_side", F.lit(1)))
            merged = latest(both, [key], [*version, "_side"]).drop("_side")
        else:
            merged = merge_rows(affected, incoming, [key])
        return versions.replace_partitions(arranged(merged, date, sort), path, months, base)
    finally:
        files.delete(spark, staged)
