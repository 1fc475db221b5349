"""Parquet sinks with manifests: full rebuild, partitioned by month or year of a date, sorted for pruning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from finmarts.functions.calendar import year_month
from finmarts.sources.versions import Manifest, Sources, replace

#: Partition column of tables split by the month of a date, as yyyymm.
MONTH = "ym"
#: Partition column of tables split by the year of a date.
YEAR = "yr"

#: Partition of rows without a date.
UNDATED = 0

PARTITION_BY = {
    MONTH: lambda day: F.coalesce(year_month(day), F.lit(UNDATED)),
    YEAR: lambda day: F.coalesce(F.year(day), F.lit(UNDATED)),
}


def partition_of(by: str, day: Column) -> Column:
    return PARTITION_BY[by](day)


def arranged(df: DataFrame, date: str | None, sort: Sequence[str] = (), by: str = MONTH) -> DataFrame:
    """Rows laid out for writing: partition column added, balanced, sorted inside files.

    The rebalance groups rows by partition folder but splits a folder that exceeds
    the advisory size over several tasks, so a month with a third of the table is
    not one writer; small months share a task. Sorting gives tight row-group bounds.
    """
    if date is None:
        return df.sortWithinPartitions(*sort) if sort else df
    return laid_out_by(df.withColumn(by, partition_of(by, F.col(date))), by, sort)


def laid_out_by(keyed: DataFrame, by: str, sort: Sequence[str] = ()) -> DataFrame:
    """As `arranged`, for rows that have their partition column."""
    return keyed.hint("rebalance", F.col(by)).sortWithinPartitions(by, *sort)


def write_table(
    df: DataFrame,
    path: str,
    date: str | None = None,
    sort: Sequence[str] = (),
    by: str = MONTH,
    sources: Sources | None = None,
    marks: Mapping[str, str] | None = None,
) -> Manifest:
    """Full rebuild of the table at ``path``; readers see the old one until the new one is whole."""
    return replace(arranged(df, date, sort, by), path, by if date is not None else None, sources, marks)
