import datetime as dt

from helpers import day, rows
from pyspark.sql import functions as F

from finmarts.functions import calendar as cal
from finmarts.functions.calendar import CalendarRange


def test_default_calendar_has_every_day_once(spark):
    dates = cal.dim_date(spark)
    assert dates.count() == 4018 == dates.select("date_id").distinct().count()
    assert dates.agg(F.min("date_actual"), F.max("date_actual")).first() == (day("2020-01-01"), day("2030-12-31"))


def test_attributes_of_known_days(spark):
    dates = {r.date_actual: r for r in cal.dim_date(spark).collect()}
    leap = dates[day("2024-02-29")]
    assert (leap.date_id, leap.is_month_end, leap.is_quarter_end, leap.season) == (20240229, 1, 0, "Зима")
    assert (leap.month_name, leap.day_name, leap.day_of_week, leap.ytd_day_number) == ("Февраль", "Четверг", 4, 60)
    year_end = dates[day("2023-12-31")]
    assert (year_end.is_year_end, year_end.is_quarter_end, year_end.day_of_week, year_end.is_weekend) == (1, 1, 7, 1)
    assert (year_end.half_year, year_end.season, year_end.week_of_year) == (2, "Зима", 52)
    assert dates[day("2024-12-30")].week_of_year == 1
    assert [dates[dt.date(2024, m, 1)].season for m in (3, 6, 9, 12)] == ["Весна", "Лето", "Осень", "Зима"]


def test_week_label_uses_the_iso_year(spark):
    days = spark.createDataFrame([(day("2024-12-30"),), (day("2021-01-01"),), (day("2024-01-15"),)], "d date")
    labels = days.select(cal.week_label(cal.week_start(F.col("d"))).alias("w"))
    assert [r.w for r in labels.collect()] == ["2025-W01", "2020-W53", "2024-W03"]


def test_date_key_equals_the_left_join_to_the_dimension(spark):
    calendar = CalendarRange(day("2024-01-01"), day("2024-12-31"))
    days = spark.createDataFrame([(day(d),) for d in ("2023-12-31", "2024-01-01", "2024-12-31", "2025-01-01")], "d date")
    joined = days.join(cal.dim_date(spark, calendar), F.col("d") == F.col("date_actual"), "left").select("d", "date_id")
    assert rows(days.select("d", cal.date_key(F.col("d"), calendar))) == rows(joined)


def test_month_and_quarter_borders(spark):
    d = spark.createDataFrame([(day("2024-01-31"),), (day("2023-11-30"),)], "d date")
    got = d.select(
        cal.next_month_end(F.col("d")).alias("n"), cal.quarter_end(F.col("d")).alias("q"),
        cal.previous_month_end(F.col("d")).alias("p"),
    ).collect()
    assert [tuple(r) for r in got] == [
        (day("2024-02-29"), day("2024-03-31"), day("2023-12-31")),
        (day("2023-12-31"), day("2023-12-31"), day("2023-10-31")),
    ]
