"""Reports on the hand-kept P&L, payment and expense registers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from finmarts.functions import calendar as cal
from finmarts.functions.numeric import money, percent, sum_total

PNL_MEASURES = ["revenue", "cogs", "gross_profit", "operating_cost", "ebitda", "net_profit", "tax"]


def typed_pnl(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("month").isNotNull() & (F.col("city_id") > 0)).select(
        F.col("month").cast("date").alias("month"),
        "city_id",
        "cat_id",
        *[money(c).alias(c) for c in PNL_MEASURES],
    )


def typed_payments(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("dt").isNotNull()).select(
        F.col("dt").cast("date").alias("dt"),
        "city_id",
        "cp_id",
        "cat_id",
        "doc_number",
        *[money(c).alias(c) for c in ("planned_sales", "amount_to_pay", "balance")],
        F.col("is_paid").cast("int").alias("is_paid"),
        F.col("due_date").cast("date").alias("due_date"),
    )


def typed_expenses(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("dt").isNotNull() & (F.col("amount") > 0)).select(
        F.col("dt").cast("date").alias("dt"),
        "city_id",
        "cp_id",
        "cat_id",
        "doc_number",
        F.col("mc_flag").cast("int").alias("mc_flag"),
        "item_name",
        money("amount").alias("amount"),
        F.col("has_category").cast("int").alias("has_category"),
    )


def pnl_monthly(pnl: DataFrame, cities: DataFrame) -> DataFrame:
    """Sums and margins per month and city.

    The register is aggregated by city id before the names are joined, so the join
    and everything after it handle months × cities rows.
    """
    sums = ["revenue", "gross_profit", "ebitda", "net_profit"]
    by_id = pnl.groupBy("month", "city_id").agg(*[sum_total(c).alias(c) for c in sums])
    by_name = (
        by_id.join(cities.select("city_id", "city_name"), "city_id")
        .groupBy("month", "city_name")
        .agg(*[sum_total(c).alias(c) for c in sums])
    )
    return by_name.select(
        "*",
        percent("net_profit", "revenue", 1).alias("net_margin_pct"),
        percent("ebitda", "revenue", 1).alias("ebitda_margin_pct"),
        percent("gross_profit", "revenue", 1).alias("gross_margin_pct"),
    )


def payment_calendar(payments: DataFrame) -> DataFrame:
    """Planned sales, payments due and balance per day."""
    return payments.groupBy("dt").agg(
        *[sum_total(c).alias(c) for c in ("planned_sales", "amount_to_pay", "balance")]
    )


def unpaid(payments: DataFrame, counterparties: DataFrame, categories: DataFrame) -> DataFrame:
    """Unpaid amounts per due date, counterparty and expense kind, aggregated before the joins."""
    by_id = (
        payments.where(F.col("is_paid") == 0)
        .groupBy("due_date", "cp_id", "cat_id")
        .agg(sum_total("amount_to_pay").alias("amount"))
    )
    return (
        by_id.join(counterparties.select("cp_id", "cp_name"), "cp_id")
        .join(categories.select("cat_id", F.col("stat_name").alias("expense_stat")), "cat_id")
        .groupBy("due_date", "cp_name", "expense_stat")
        .agg(sum_total("amount").alias("total_amount"))
    )


def expenses_detail(
    expenses: DataFrame, cities: DataFrame, counterparties: DataFrame, categories: DataFrame
) -> DataFrame:
    """Expense register with names; the category may be missing."""
    return (
        expenses.join(cities.select("city_id", "city_name"), "city_id")
        .join(counterparties.select("cp_id", "cp_name"), "cp_id")
        .join(categories.select("cat_id", "group_name", "group_stat", "stat_name"), "cat_id", "left")
        .select(
            "dt",
            cal.month_start(F.col("dt")).alias("month"),
            "city_name",
            "cp_name",
            "group_name",
            "group_stat",
            "stat_name",
            "doc_number",
            "item_name",
            "amount",
            "mc_flag",
            "has_category",
        )
    )


def expenses_no_category(expenses: DataFrame, cities: DataFrame, counterparties: DataFrame) -> DataFrame:
    """Expenses still without a category."""
    return (
        expenses.where(F.col("has_category") == 0)
        .join(cities.select("city_id", "city_name"), "city_id")
        .join(counterparties.select("cp_id", "cp_name"), "cp_id")
        .select(
            cal.month_start(F.col("dt")).alias("month"), "city_name", "cp_name", "doc_number", "item_name", "amount"
        )
    )
