import datetime as dt
from collections import defaultdict
from decimal import Decimal

from helpers import day, rows
from pyspark.sql import functions as F

from finmarts.functions.calendar import CalendarRange
from finmarts.operators.periods import explode_periods
from finmarts.plans import pnl, sales


def month_end(d: dt.date) -> dt.date:
    return (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)


def test_one_day_falls_into_its_periods(spark):
    df = spark.createDataFrame([(day("2024-01-31"), 1)], "d date, v int")
    got = {(r.period_type, r.period_start): r for r in explode_periods(df, "d").collect()}
    assert got["week", day("2024-01-29")].period_label == "2024-W05"
    assert got["month", day("2024-01-01")].period_end == day("2024-01-31")
    quarter = got["quarter", day("2024-01-01")]
    assert (quarter.period_end, quarter.period_label, quarter.month) == (day("2024-03-31"), "2024-Q1", 1)
    own = got["rolling_45d", day("2023-12-18")]
    assert (own.period_end, own._own_end, own.period_label) == (day("2024-01-31"), True, "2023-12-18 → 2024-01-31")
    following = got["rolling_45d", day("2024-01-16")]
    assert (following.period_end, following._own_end) == (day("2024-02-29"), False)
    assert len(got) == 5


def test_early_day_has_one_rolling_window(spark):
    df = spark.createDataFrame([(day("2024-01-15"),)], "d date")
    assert explode_periods(df, "d", ["rolling_45d"]).count() == 1


def test_rolling_windows_equal_the_range_join(spark, plan):
    days = [day("2023-01-01") + dt.timedelta(days=i) for i in range(0, 800, 3)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "d date, v int")
    windows = pnl.rolling_with_data(
        explode_periods(df, "d", ["rolling_45d"])
        .groupBy("period_type", "period_end")
        .agg(F.sum("v").alias("v"), F.max("_own_end").alias("_own_end"))
    )
    ends = {month_end(d) for d in days}
    brute = sorted(
        ((e, sum(i for i, d in enumerate(days) if e - dt.timedelta(days=44) <= d <= e)) for e in ends), key=repr
    )
    assert rows(windows, "period_end", "v") == brute
    assert "NestedLoop" not in plan(windows)


def test_window_end_needs_data_of_its_month(spark):
    # the January row reaches into the window ending in February, where no row exists
    df = spark.createDataFrame([(day("2024-01-31"), 1)], "d date, v int")
    windows = explode_periods(df, "d", ["rolling_45d"]).groupBy("period_type", "period_end").agg(
        F.max("_own_end").alias("_own_end")
    )
    assert rows(pnl.rolling_with_data(windows), "period_end") == [(day("2024-01-31"),)]


SALE = (
    "order_date date, client_segment string, product_category string, client_id bigint, order_id bigint, "
    "line_revenue decimal(18,2), line_cogs decimal(18,2), line_gross_profit decimal(18,2), quantity bigint, "
    "order_status string"
)
CALENDAR = CalendarRange(day("2023-01-01"), day("2025-12-31"))


def test_orders_and_clients_are_distinct_at_every_grain(spark):
    """Clients by first occurrence against plain sets; a third of all lines belongs to one client."""
    lines = []
    for order in range(600):
        placed = day("2023-11-20") + dt.timedelta(days=(order * 7) % 190)
        client = 1 if order % 3 == 0 else order % 11
        for line in range(1 + order % 3):
            status = "cancelled" if order % 10 == 9 else "completed"
            category = f"c{(order + line) % 2}"
            lines.append((placed, "A", category, client, order, Decimal(10), Decimal(6), Decimal(4), 1, status))
    got = sales.sales_by_period(spark.createDataFrame(lines, SALE), CALENDAR)

    expected = defaultdict(lambda: (set(), set(), []))
    for placed, _, category, client, order, *_, status in lines:
        if status == "cancelled":
            continue
        monday = placed - dt.timedelta(days=placed.weekday())
        quarter = dt.date(placed.year, 3 * ((placed.month - 1) // 3) + 1, 1)
        keys = [("week", monday, placed.year, quarter.month), ("month", placed.replace(day=1), placed.year, quarter.month),
                ("quarter", quarter, placed.year, quarter.month)]
        following = month_end(month_end(placed) + dt.timedelta(days=1))
        for end in (month_end(placed), following):
            start = end - dt.timedelta(days=44)
            if start <= placed <= end:
                keys.append(("rolling_45d", start, end.year, 3 * ((end.month - 1) // 3) + 1))
        for key in keys:
            orders, clients, count = expected[(*key, category)]
            orders.add(order)
            clients.add(client)
            count.append(1)
    brute = sorted(
        ((k[0], k[1], k[2], (k[3] - 1) // 3 + 1, k[4], len(o), len(c), len(n)) for k, (o, c, n) in expected.items()),
        key=repr,
    )
    columns = ["period_type", "period_start", "year", "quarter", "product_category", "order_count", "unique_clients", "quantity"]
    assert rows(got, *columns) == brute


def test_rolling_sales_windows_stop_at_the_calendar(spark):
    line = (day("2025-12-31"), "A", "c", 1, 1, Decimal(1), Decimal(0), Decimal(1), 1, "completed")
    got = sales.sales_by_period(spark.createDataFrame([line], SALE), CALENDAR).where("period_type = 'rolling_45d'")
    assert rows(got, "period_end") == [(day("2025-12-31"),)]
