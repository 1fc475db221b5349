"""Money types, conditional sums and null-safe ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Row-level money.
MONEY = "decimal(18,2)"
#: Sums of money: what ``sum(decimal(18,2))`` yields, wide enough for any number of rows.
TOTAL = "decimal(28,2)"
#: Discount fractions.
FRACTION = "decimal(18,4)"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value: Column | str) -> Column:
    return col(value).cast(MONEY)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def sum_total(value: Column | str) -> Column:
    return F.sum(col(value)).cast(TOTAL)


def sum_if(value: Column | str, condition: Column) -> Column:
    """Sum over the rows meeting the condition; 0 when none does."""
    return F.coalesce(F.sum(F.when(condition, col(value))), F.lit(0)).cast(TOTAL)


def safe_ratio(numerator: Column | str, denominator: Column | str, digits: int = 2, scale: int = 1) -> Column:
    """``numerator / denominator * scale`` rounded once at the end; null for a zero denominator.

    The division runs in double, so the result does not depend on decimal scale rules.
    """
    ratio = F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))
    return F.round(ratio * scale if scale != 1 else ratio, digits)


def percent(numerator: Column | str, denominator: Column | str, digits: int = 2) -> Column:
    return safe_ratio(numerator, denominator, digits, scale=100)
