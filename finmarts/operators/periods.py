"""Reporting periods: week, month, quarter and rolling 45 days ending at a month end."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from finmarts.functions import calendar as cal

ROLLING_DAYS = 45
GRAINS = ("week", "month", "quarter", "rolling_45d")
PERIOD_COLUMNS = ["period_type", "period_start", "period_end", "period_label", "year", "quarter", "month"]


#: The periods one date can fall into; a rolling window may end with its own or with the next month.
SLOTS = ("week", "month", "quarter", "rolling_own", "rolling_next")


def explode_periods(
    df: DataFrame,
    date: str,
    grains: Sequence[str] = GRAINS,
    per_slot: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """Repeat every row once per reporting period its date falls into.

    A date lies in one week, month and quarter and in at most two rolling windows:
    the one ending with its own month, and the next one if it is within the last
    45 days of it (two months span at least 59 days, so never a third). That turns
    the range join between window ends and facts into a projection. ``_own_end`` is
    false only for that second window: it tells whether the period's month holds
    data of its own. Aggregate to days before calling this; the input grows 4-5 times.

    ``per_slot`` maps a new column to the column it takes in each slot, for measures
    that differ by period. The columns named there are not passed on themselves.
    """
    day = F.col(date)
    per_slot = per_slot or {}
    periods = {
        "week": _week(day),
        "month": _month(day),
        "quarter": _quarter(day),
        "rolling_own": _rolling(cal.month_end(day)),
        "rolling_next": _rolling(cal.next_month_end(day)),
    }

    def struct(slot: str) -> Column:
        fields = [value.alias(name) for name, value in zip(PERIOD_COLUMNS, periods[slot])]
        fields.append(F.lit(slot != "rolling_next").alias("_own_end"))
        fields += [F.col(source[slot]).alias(name) for name, source in per_slot.items()]
        if slot != "rolling_next":
            return F.struct(*fields)
        return F.when(day >= F.date_sub(cal.next_month_end(day), ROLLING_DAYS - 1), F.struct(*fields))

    slots = [slot for slot in SLOTS if slot in grains or (slot.startswith("rolling") and "rolling_45d" in grains)]
    exploded = df.withColumn("_period", F.explode(F.array_compact(F.array(*[struct(s) for s in slots]))))
    used = {date, *(column for source in per_slot.values() for column in source.values())}
    return exploded.select("_period.*", *[c for c in df.columns if c not in used])


def first_in_period(date: str, previous: str) -> dict[str, Column]:
    """Whether a row is the first of its series in each slot's period, given the series' previous date.

    Summing these flags counts distinct series members per period without repeating
    the rows for every period.
    """
    day, before = F.col(date), F.col(previous)
    moved = {
        # week rows are also split by quarter
        "week": (cal.week_start(before) < cal.week_start(day)) | (cal.quarter_start(before) < cal.quarter_start(day)),
        "month": cal.month_start(before) < cal.month_start(day),
        "quarter": cal.quarter_start(before) < cal.quarter_start(day),
        "rolling_own": before < F.date_sub(cal.month_end(day), ROLLING_DAYS - 1),
        "rolling_next": before < F.date_sub(cal.next_month_end(day), ROLLING_DAYS - 1),
    }
    return {slot: before.isNull() | is_new for slot, is_new in moved.items()}


def _parts(kind: str, start: Column, end: Column, label: Column, of: Column) -> list[Column]:
    return [F.lit(kind), start, end, label, F.year(of), F.quarter(of), F.month(of)]


def _week(day: Column) -> list[Column]:
    # year, quarter and month are those of the day: a week crossing a border gives two rows
    monday = cal.week_start(day)
    return _parts("week", monday, F.date_add(monday, 6), cal.week_label(monday), day)


def _month(day: Column) -> list[Column]:
    start = cal.month_start(day)
    return _parts("month", start, cal.month_end(day), cal.month_label(start), start)


def _quarter(day: Column) -> list[Column]:
    start = cal.quarter_start(day)
    return _parts("quarter", start, cal.quarter_end(day), cal.quarter_label(start), start)


def _rolling(end: Column) -> list[Column]:
    start = F.date_sub(end, ROLLING_DAYS - 1)
    label = F.concat(start.cast("string"), F.lit(" → "), end.cast("string"))
    return _parts("rolling_45d", start, end, label, end)
