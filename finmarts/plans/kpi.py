"""Executive KPI: one row per month and scenario."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from finmarts.functions.calendar import month_name
from finmarts.functions.numeric import percent
from finmarts.operators.changes import previous_month

COLUMNS = [
    "period", "period_label", "year", "quarter", "month", "scenario_id", "scenario_name", "revenue",
    "gross_profit", "gross_margin_pct", "ebitda", "ebitda_margin_pct", "net_profit", "net_margin_pct",
    "revenue_mom_pct", "net_profit_mom_pct", "revenue_ytd", "net_profit_ytd", "total_assets", "total_equity",
    "current_ratio", "debt_to_equity", "roe", "roa", "operating_cf", "net_cash_flow", "closing_cash",
    "cash_conversion",
]


def with_month_change(months: DataFrame) -> DataFrame:
    """Change of revenue and net profit against the month before, in percent."""
    both = previous_month(
        months,
        ["scenario_id"],
        "period_start",
        {"_prev_revenue": "revenue", "_prev_net_profit": "net_profit"},
    )
    return both.select(
        *months.columns,
        *[
            percent(F.col(value) - F.col(f"_prev_{value}"), f"_prev_{value}").alias(f"{value}_mom_pct")
            for value in ("revenue", "net_profit")
        ],
    )


def monthly(pnl_months: DataFrame, balance: DataFrame, cashflow: DataFrame) -> DataFrame:
    """P&L months with their balance (by month end) and cash flow (by month start)."""
    profit = with_month_change(pnl_months).withColumnRenamed("period_start", "period")
    sheet = balance.select(
        F.col("period").alias("period_end"), "scenario_id", "total_assets", "total_equity", "current_ratio",
        "debt_to_equity",
    )
    cash = cashflow.select("period", "scenario_id", "operating_cf", "net_cash_flow", "closing_cash")
    rows = profit.join(sheet, ["period_end", "scenario_id"], "left").join(cash, ["period", "scenario_id"], "left")
    label = F.concat(month_name(F.col("period")), F.lit(" "), F.col("year").cast("string"))
    return rows.withColumns({
        "period_label": label,
        "roe": percent("net_profit", "total_equity"),
        "roa": percent("net_profit", "total_assets"),
        "cash_conversion": percent("operating_cf", "net_profit"),
    }).select(*COLUMNS)
