"""Sales and marketing by segment and category at all grains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from finmarts.functions.calendar import CalendarRange
from finmarts.functions.numeric import percent, safe_ratio, sum_total
from finmarts.operators.periods import SLOTS, explode_periods, first_in_period
from finmarts.plans.monthly import NET_OF_CANCELLED

PERIOD = ["period_type", "period_start", "period_end", "period_label", "year", "quarter"]
SLICE = ["client_segment", "product_category"]
MONEY_SUMS = ["revenue", "cogs", "gross_profit"]
COLUMNS = [
    *PERIOD, *SLICE, "scenario_id", "scenario_name", *MONEY_SUMS, "gross_margin_pct", "quantity", "order_count",
    "avg_order_value", "unique_clients", "marketing_spend", "impressions", "clicks", "conversions", "ctr", "cpa",
    "romi",
]


def client_days(lines: DataFrame) -> DataFrame:
    """Sales per day, segment, category and client, with the number of orders.

    An order has one date and one client, because both come from its header. So
    orders can be counted once here and added up over any period. Lines move to their
    client's day once, for the sums by order and those by day.
    """
    day = ["order_date", *SLICE, "client_id"]
    by_order = (
        lines.where(NET_OF_CANCELLED)
        .repartition(*day)
        .groupBy(*day, "order_id")
        .agg(
            sum_total("line_revenue").alias("revenue"),
            sum_total("line_cogs").alias("cogs"),
            sum_total("line_gross_profit").alias("gross_profit"),
            F.sum("quantity").alias("quantity"),
        )
    )
    return by_order.groupBy(*day).agg(
        *_totals(), F.count(F.lit(1)).alias("order_count")
    )


def _totals() -> list[Column]:
    return [*[sum_total(c).alias(c) for c in MONEY_SUMS], F.sum("quantity").alias("quantity")]


def daily_sales(lines: DataFrame) -> DataFrame:
    """Sums and orders per day, segment and category, with the number of clients new to each period.

    A client counts in a period on the first of its days there, which its previous
    day tells. The flags are additive, so clients per period are distinct without
    repeating client rows for every period. A client's series has at most one row
    per day, so even one client with a large share of all orders stays small here.
    """
    series = Window.partitionBy(*SLICE, "client_id").orderBy("order_date")
    days = client_days(lines).withColumn("_previous", F.lag("order_date").over(series))
    return days.groupBy("order_date", *SLICE).agg(
        *_totals(),
        F.sum("order_count").alias("order_count"),
        *[F.count_if(is_new & F.col("client_id").isNotNull()).alias(f"_new_{slot}")
          for slot, is_new in first_in_period("order_date", "_previous").items()],
    )


def sales_by_period(lines: DataFrame, calendar: CalendarRange) -> DataFrame:
    """Sums, orders and distinct clients per period, segment and category.

    Rolling windows end at the month ends of the calendar, whether or not the month
    has sales.
    """
    in_calendar = (F.col("period_type") != "rolling_45d") | calendar.covers(F.col("period_end"))
    clients = {"unique_clients": {slot: f"_new_{slot}" for slot in SLOTS}}
    periods = explode_periods(daily_sales(lines), "order_date", per_slot=clients).where(in_calendar)
    return periods.groupBy(*PERIOD, *SLICE).agg(
        *_totals(), F.sum("order_count").alias("order_count"), F.sum("unique_clients").alias("unique_clients")
    )


def marketing_by_period(spend: DataFrame) -> DataFrame:
    """Marketing totals per period; rolling windows only for months with spend of their own."""
    measures = {"spend_amount": "marketing_spend", "impressions": "impressions", "clicks": "clicks",
                "conversions": "conversions"}
    daily = spend.groupBy("spend_date").agg(
        sum_total("spend_amount").alias("marketing_spend"), *[F.sum(c).alias(c) for c in list(measures)[1:]]
    )
    totals = (
        explode_periods(daily, "spend_date")
        .groupBy("period_type", "period_end")
        .agg(
            sum_total("marketing_spend").alias("marketing_spend"),
            *[F.sum(c).alias(c) for c in list(measures)[1:]],
            F.max("_own_end").alias("_own_end"),
        )
        .where("_own_end")
        .drop("_own_end")
    )
    return totals.withColumns({
        "ctr": percent("clicks", "impressions", 3),
        "cpa": safe_ratio("marketing_spend", "conversions"),
    })


def periodic(lines: DataFrame, spend: DataFrame, calendar: CalendarRange) -> DataFrame:
    """The full report.

    Marketing is known per period only, so its figures repeat on every segment and
    category of the period; do not add them up across rows. Both sides are
    aggregated before they meet.
    """
    sales = sales_by_period(lines, calendar)
    rows = sales.join(marketing_by_period(spend), ["period_type", "period_end"], "left")
    filled = ["marketing_spend", "impressions", "clicks", "conversions", "ctr", "cpa"]
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0).cast(rows.schema[c].dataType)) for c in filled})
    return rows.withColumns({
        "scenario_id": F.lit(1),
        "scenario_name": F.lit("Факт"),
        "gross_margin_pct": percent("gross_profit", "revenue"),
        "avg_order_value": safe_ratio("revenue", "order_count"),
        "romi": percent(F.col("gross_profit") - F.col("marketing_spend"), "marketing_spend"),
    }).select(*COLUMNS)
