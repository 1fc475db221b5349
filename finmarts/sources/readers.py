"""Readers of source tables with declared schemas."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from finmarts.sources.schemas import schema_of

#: Gives the source table of a name.
Source = Callable[[str], DataFrame]


def csv_source(spark: SparkSession, folder: str) -> Source:
    """Tables as CSV files with a header row, typed by the declared schema, no inference.

    A malformed value fails the job rather than turning into a null.
    """

    def read(table: str) -> DataFrame:
        return spark.read.schema(schema_of(table)).csv(
            os.path.join(folder, f"{table}.csv"), header=True, mode="FAILFAST", dateFormat="yyyy-MM-dd"
        )

    return read


def parquet_source(spark: SparkSession, folder: str) -> Source:
    """Tables as parquet files or folders named after the table."""

    def read(table: str) -> DataFrame:
        return spark.read.schema(schema_of(table)).parquet(os.path.join(folder, table))

    return read
