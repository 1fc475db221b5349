"""Profit and loss at week, month, quarter and rolling-45-day grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from finmarts.functions import calendar as cal
from finmarts.functions.numeric import TOTAL, percent, sum_if, sum_total
from finmarts.operators.changes import year_to_date
from finmarts.operators.periods import PERIOD_COLUMNS, explode_periods
from finmarts.plans.dims import scenario_name

# Report line -> statement group. Expenses are shown as positive amounts.
EXPENSE_LINES = {
    "cogs": "cogs",
    "opex": "opex",
    "depreciation": "depreciation",
    "financial_exp": "financial",
    "tax": "tax",
}
LINES = ["revenue", *EXPENSE_LINES]
STATEMENT_COLUMNS = [
    "revenue", "cogs", "gross_profit", "gross_margin_pct", "opex", "depreciation", "ebitda",
    "ebitda_margin_pct", "ebit", "financial_exp", "ebt", "tax", "net_profit", "net_margin_pct",
    "revenue_ytd", "net_profit_ytd",
]


def pivot_lines(amount: str) -> list[Column]:
    """One sum per report line over signed amounts."""
    group = F.col("pl_group")
    expenses = [(-sum_if(amount, group == code)).cast(TOTAL).alias(line) for line, code in EXPENSE_LINES.items()]
    return [sum_if(amount, group == "revenue").alias("revenue"), *expenses]


def waterfall(lines: DataFrame) -> DataFrame:
    """Revenue down to net profit, with margins in percent of revenue."""
    steps = {"gross_profit": "cogs", "ebitda": "opex", "ebit": "depreciation", "ebt": "financial_exp", "net_profit": "tax"}
    profits, left = {}, F.col("revenue")
    for name, cost in steps.items():
        left = (left - F.col(cost)).cast(TOTAL)
        profits[name] = left
    margins = {"gross_margin_pct": "gross_profit", "ebitda_margin_pct": "ebitda", "net_margin_pct": "net_profit"}
    return lines.withColumns(profits | {name: percent(profits[of], "revenue") for name, of in margins.items()})


def with_year_to_date(statement: DataFrame) -> DataFrame:
    """Year-to-date revenue and profit on month rows, null on the other grains."""
    is_month = F.col("period_type") == "month"
    series = ["period_type", "year", "scenario_id"]
    return statement.withColumns({
        f"{value}_ytd": F.when(is_month, year_to_date(value, series, "period_start"))
        for value in ("revenue", "net_profit")
    })


def _finish(lines: DataFrame) -> DataFrame:
    complete = with_year_to_date(waterfall(lines))
    return complete.select(*PERIOD_COLUMNS, "scenario_id", scenario_name(), *STATEMENT_COLUMNS)


def daily_lines(gl: DataFrame, amount: str = "signed_amount") -> DataFrame:
    """P&L lines by day and scenario: the only step whose cost depends on the ledger's size."""
    return (
        gl.where(F.col("statement_type") == "pl")
        .groupBy("posting_date", "scenario_id")
        .agg(*pivot_lines(amount))
    )


def rolling_with_data(periods: DataFrame, own_end: str = "_own_end") -> DataFrame:
    """Keep rolling windows only for month ends whose month holds data in any scenario."""
    same_end = Window.partitionBy("period_type", "period_end")
    return periods.withColumn("_has_data", F.max(own_end).over(same_end)).where("_has_data").drop("_has_data", own_end)


def periodic(gl: DataFrame, amount: str = "signed_amount") -> DataFrame:
    """The full report, from the ledger or its sums by day, account and scenario.

    All grains come from one daily aggregate, so the ledger is read once.
    """
    by_period = (
        explode_periods(daily_lines(gl, amount), "posting_date")
        .groupBy(*PERIOD_COLUMNS, "scenario_id")
        .agg(*[sum_total(line).alias(line) for line in LINES], F.max("_own_end").alias("_own_end"))
    )
    return _finish(rolling_with_data(by_period))


def monthly(int_pnl: DataFrame) -> DataFrame:
    """The month rows of the report from the monthly aggregate."""
    start = F.col("period")
    lines = int_pnl.groupBy("period", "year", "quarter", "scenario_id").agg(*pivot_lines("total_signed"))
    return _finish(
        lines.select(
            F.lit("month").alias("period_type"),
            start.alias("period_start"),
            cal.month_end(start).alias("period_end"),
            cal.month_label(start).alias("period_label"),
            "year",
            "quarter",
            F.month(start).alias("month"),
            "scenario_id",
            *LINES,
        )
    )
