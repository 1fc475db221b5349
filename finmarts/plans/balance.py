"""Monthly balance sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from finmarts.functions.numeric import TOTAL, flag, percent, safe_ratio, sum_if
from finmarts.plans.dims import scenario_name

# Report line -> balance-sheet group.
LINES = {
    "current_assets": "current_assets",
    "non_current_assets": "noncurrent_assets",
    "current_liabilities": "current_liabilities",
    "non_current_liab": "noncurrent_liabilities",
    "total_equity": "equity",
}
COLUMNS = [
    "period", "year", "quarter", "month", "scenario_id", "scenario_name", "current_assets", "non_current_assets", "total_assets",
    "current_liabilities", "non_current_liab", "total_liabilities", "total_equity", "total_liab_equity",
    "balance_diff", "is_balanced", "current_ratio", "debt_to_equity", "equity_ratio",
]


def monthly(int_balance: DataFrame) -> DataFrame:
    """Groups side by side, totals, the balance check and three ratios."""
    lines = int_balance.groupBy("period", "scenario_id").agg(
        *[sum_if("ending_balance", F.col("bs_group") == code).alias(line) for line, code in LINES.items()]
    )
    assets = F.col("current_assets") + F.col("non_current_assets")
    liabilities = F.col("current_liabilities") + F.col("non_current_liab")
    financing = liabilities + F.col("total_equity")
    totals = {
        "total_assets": assets,
        "total_liabilities": liabilities,
        "total_liab_equity": financing,
        "balance_diff": assets - financing,
    }
    sheet = lines.withColumns({name: value.cast(TOTAL) for name, value in totals.items()})
    return sheet.withColumns({
        "year": F.year("period"),
        "quarter": F.quarter("period"),
        "month": F.month("period"),
        "scenario_name": scenario_name(),
        "is_balanced": flag(F.abs("balance_diff") < 1),
        "current_ratio": safe_ratio("current_assets", "current_liabilities"),
        "debt_to_equity": safe_ratio("total_liabilities", "total_equity"),
        "equity_ratio": percent("total_equity", "total_assets"),
    }).select(*COLUMNS)
