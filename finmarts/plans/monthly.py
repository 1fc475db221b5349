"""Monthly aggregates of the facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from finmarts.functions import calendar as cal, rules
from finmarts.functions.numeric import TOTAL, sum_total

NET_OF_CANCELLED = "order_status != 'cancelled'"
GL_KEYS = ["account_id", "scenario_id", "statement_type", "pl_group", "bs_group"]


def gl_monthly(gl: DataFrame) -> DataFrame:
    """Every measure the monthly statements need, per month, account and scenario.

    One pass over the ledger serves both the P&L and the balance side; its size is
    months × accounts × scenarios, whatever the number of postings.
    """
    return gl.groupBy(cal.month_start(F.col("posting_date")).alias("month"), *GL_KEYS).agg(*_gl_measures())


def gl_daily(gl: DataFrame) -> DataFrame:
    """The measures of ``gl_monthly`` by day, for where the ledger also serves the report by week and rolling window."""
    return gl.groupBy("posting_date", *GL_KEYS).agg(*_gl_measures())


def _gl_measures() -> list[Column]:
    return [
        sum_total("signed_amount").alias("total_signed"),
        sum_total("amount_base").alias("total_raw"),
        sum_total(rules.balance_amount(F.col("amount_base"), F.col("normal_balance"))).alias("net_movement"),
        F.count(F.lit(1)).alias("posting_count"),
    ]


def gl_months_of_days(gl_day: DataFrame) -> DataFrame:
    """``gl_monthly`` from ``gl_daily``."""
    return gl_day.groupBy(cal.month_start(F.col("posting_date")).alias("month"), *GL_KEYS).agg(
        *[sum_total(c).alias(c) for c in ("total_signed", "total_raw", "net_movement")],
        F.sum("posting_count").alias("posting_count"),
    )


def pnl(gl_month: DataFrame) -> DataFrame:
    """P&L accounts by month (first day), from ``gl_monthly``."""
    month = F.col("month")
    return (
        gl_month.where(F.col("statement_type") == "pl")
        .groupBy(
            month.alias("period"),
            F.year(month).alias("year"),
            F.quarter(month).alias("quarter"),
            "account_id",
            "pl_group",
            "scenario_id",
        )
        .agg(
            sum_total("total_signed").alias("total_signed"),
            sum_total("total_raw").alias("total_raw"),
            F.sum("posting_count").alias("posting_count"),
        )
    )


def balance(gl_month: DataFrame) -> DataFrame:
    """Balance accounts by month (last day), from ``gl_monthly``.

    ``ending_balance`` is the net movement of the month, as the reports define it,
    not a running balance.
    """
    return (
        gl_month.where(F.col("statement_type") == "bs")
        .groupBy(cal.month_end(F.col("month")).alias("period"), "account_id", "bs_group", "scenario_id")
        .agg(sum_total("net_movement").alias("ending_balance"))
    )


def sales(lines: DataFrame) -> DataFrame:
    """Sales by month, client and product without cancelled orders.

    Lines move to their month, client and product once, for the counting of orders and for the sums.
    """
    day = F.col("order_date")
    attributes = ["client_segment", "client_region", "product_category", "product_brand", "margin_group"]
    group = ["period", "year", "quarter", "client_id", *attributes[:2], "product_id", *attributes[2:]]
    rows = lines.where(NET_OF_CANCELLED).withColumns({
        "period": cal.month_start(day), "year": F.year(day), "quarter": F.quarter(day),
    })
    money = {"revenue": "line_revenue", "cogs": "line_cogs", "gross_profit": "line_gross_profit"}
    by_order = (
        rows.repartition("period", "client_id", "product_id")
        .groupBy(*group, "order_id")
        .agg(*[sum_total(of).alias(name) for name, of in money.items()], F.sum("quantity").alias("quantity"))
    )
    return by_order.groupBy(*group).agg(
        *[sum_total(name).alias(name) for name in money],
        F.sum("quantity").alias("quantity"),
        F.count("order_id").alias("order_count"),
    )
