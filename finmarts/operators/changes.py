"""Month-over-month access and year-to-date sums on monthly aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from finmarts.functions.numeric import TOTAL


def previous_month(
    df: DataFrame, keys: Sequence[str], period: str, values: dict[str, str], month_ends: bool = False
) -> DataFrame:
    """Add the values of exactly the previous month, null where that month has no row.

    ``values`` maps a new column to the column it is taken from. One window pass
    replaces the self join; a gap between months is seen by comparing dates.
    """
    series = Window.partitionBy(*keys).orderBy(period)
    expected = F.add_months(F.col(period), -1)
    if month_ends:
        expected = F.last_day(expected)
    adjacent = F.lag(period).over(series) == expected
    return df.select(
        "*", *[F.when(adjacent, F.lag(source).over(series)).alias(name) for name, source in values.items()]
    )


def year_to_date(value: str, keys: Sequence[str], period: str) -> Column:
    """Running sum within ``keys`` (which hold the year), in period order."""
    so_far = Window.partitionBy(*keys).orderBy(period).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return F.sum(value).over(so_far).cast(TOTAL)
