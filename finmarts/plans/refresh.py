"""Which parts of an aggregate a change of its facts reaches, by month and year.

Aggregates are kept by year. A month's change reaches its year; reports with periods that cross the new year are kept by
the year in which a period starts, so a January also reaches weeks and rolling windows that start in the year before.
Year-to-date values stay within their year.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from finmarts.sources.sinks import UNDATED

JANUARY = 1


def years_of(months: Iterable[int]) -> list[int]:
    """The years of months (yyyymm); rows without a date are in a year of their own."""
    return sorted({m // 100 for m in months})


def years_of_periods(months: Iterable[int]) -> list[int]:
    """The years in which a week, month, quarter or rolling window may start that holds days of the months."""
    months = list(months)
    return sorted({m // 100 for m in months} | {m // 100 - 1 for m in months if m != UNDATED and m % 100 == JANUARY})


def months_of(years: Iterable[int]) -> list[tuple[int, int]]:
    """(first, last) month of each year."""
    return [(UNDATED, UNDATED) if y == 0 else (y * 100 + 1, y * 100 + 12) for y in years]


def months_of_periods(years: Iterable[int]) -> list[tuple[int, int]]:
    """(first, last) month with days of periods that start in each year: the longest such ends in January."""
    return [(UNDATED, UNDATED) if y == 0 else (y * 100 + 1, (y + 1) * 100 + JANUARY) for y in years]


def between_months(table: DataFrame, month: str, spans: Iterable[tuple[int, int]]) -> DataFrame:
    """Rows of some spans of months, as a filter on the month column, which chooses folders."""
    found = F.lit(False)
    for first, last in spans:
        found = found | F.col(month).between(first, last)
    return table.where(found)
