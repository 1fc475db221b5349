"""Calendar arithmetic and the date dimension."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from finmarts.functions.numeric import flag

# Display names of months, weekdays and seasons.
MONTH_NAMES = [
    "Январь", "Февраль", "Март", "Апрель", "Май", "Июнь",
    "Июль", "Август", "Сентябрь", "Октябрь", "Ноябрь", "Декабрь",
]
DAY_NAMES = ["Понедельник", "Вторник", "Среда", "Четверг", "Пятница", "Суббота", "Воскресенье"]
SEASONS = ["Зима", "Весна", "Лето", "Осень"]


@dataclass(frozen=True)
class CalendarRange:
    """Days covered by the date dimension, both ends included."""

    start: dt.date = dt.date(2020, 1, 1)
    end: dt.date = dt.date(2030, 12, 31)

    def covers(self, day: Column) -> Column:
        return day.between(F.lit(self.start), F.lit(self.end))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def next_month_end(day: Column) -> Column:
    return F.last_day(F.add_months(month_start(day), 1))


def previous_month_end(day: Column) -> Column:
    return F.date_sub(month_start(day), 1)


def quarter_start(day: Column) -> Column:
    return F.trunc(day, "quarter")


def quarter_end(day: Column) -> Column:
    return F.last_day(F.add_months(quarter_start(day), 2))


def week_start(day: Column) -> Column:
    return F.trunc(day, "week")


def iso_weekday(day: Column) -> Column:
    """1 = Monday … 7 = Sunday."""
    return F.weekday(day) + 1


def week_label(monday: Column) -> Column:
    """``YYYY-Wnn`` from the ISO year and the ISO week, so 2024-12-30 is 2025-W01."""
    year = F.extract(F.lit("YEAROFWEEK"), monday).cast("string")
    return F.concat(year, F.lit("-W"), F.lpad(F.weekofyear(monday).cast("string"), 2, "0"))


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def quarter_label(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))


def date_number(day: Column) -> Column:
    """The day as the integer yyyymmdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def year_month(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def date_key(day: Column, calendar: CalendarRange) -> Column:
    """Key into the date dimension; null outside the calendar.

    The dimension has one row for every day of its range, so a left join to it
    can only ever return this number: computing it saves the join.
    """
    return F.when(calendar.covers(day), date_number(day))


def nth_name(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in names]), position)


def month_name(day: Column) -> Column:
    return nth_name(MONTH_NAMES, F.month(day))


def date_attributes(day: Column) -> dict[str, Column]:
    """Every column of the date dimension for one date column."""
    month = F.month(day)
    weekday = iso_weekday(day)
    ends_month = day == month_end(day)
    return {
        "date_id": date_number(day),
        "date_actual": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": month,
        "month_name": month_name(day),
        "week_of_year": F.weekofyear(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": weekday,
        "day_name": nth_name(DAY_NAMES, weekday),
        "is_weekend": flag(weekday >= 6),
        "is_month_end": flag(ends_month),
        "is_quarter_end": flag(ends_month & (month % 3 == 0)),
        "is_year_end": flag((month == 12) & (F.dayofmonth(day) == 31)),
        "season": nth_name(SEASONS, F.floor(month % 12 / 3).cast("int") + 1),
        "half_year": F.when(month <= 6, 1).otherwise(2),
        "ytd_day_number": F.dayofyear(day),
    }


def select_date_attributes(days: DataFrame, column: str = "date_actual") -> DataFrame:
    return days.select(*[c.alias(name) for name, c in date_attributes(F.col(column)).items()])


def dim_date(spark: SparkSession, calendar: CalendarRange = CalendarRange()) -> DataFrame:
    """One row per day of the calendar."""
    spine = spark.range(1).select(
        F.explode(F.sequence(F.lit(calendar.start), F.lit(calendar.end))).alias("date_actual")
    )
    return select_date_attributes(spine)


def days_between_first_and_last(df: DataFrame, date: str) -> DataFrame:
    """Every day from the earliest to the latest date of a table, as ``date_actual``."""
    bounds = df.agg(F.min(date).alias("first"), F.max(date).alias("last"))
    return bounds.where(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last")).alias("date_actual")
    )
