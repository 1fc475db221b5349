"""The register lineage (seed files) as named tables."""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from finmarts.operators.checks import run_checks
from finmarts.plans import expenses
from finmarts.plans.expectations import EXPECTATIONS
from finmarts.sources.readers import Source
from finmarts.sources.sinks import MONTH, write_table

#: Report -> (date the files are split by, sort order inside the files).
LAYOUT = {
    "mart_pnl_monthly": ("month", ["month", "city_name"]),
    "mart_payment_calendar": ("dt", ["dt"]),
    "mart_unpaid": (None, ["due_date", "cp_name"]),
    "mart_expenses_detail": ("dt", ["dt", "city_name"]),
    "mart_expenses_no_category": ("month", ["month", "city_name"]),
}


class Reports:
    def __init__(self, source: Source) -> None:
        self.source = source

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def checks(self, name: str) -> DataFrame:
        return run_checks(self.table(name), name, EXPECTATIONS[name])

    def publish(self, path: str) -> None:
        """Rebuild every report below ``path``."""
        for name, (date, sort) in LAYOUT.items():
            rows = self.table(name).withColumn("_loaded_at_ts", F.unix_timestamp())
            write_table(rows, os.path.join(path, name), date, sort, MONTH)

    @cached_property
    def stg_pnl(self) -> DataFrame:
        return expenses.typed_pnl(self.source("fact_pnl"))

    @cached_property
    def stg_payments(self) -> DataFrame:
        return expenses.typed_payments(self.source("fact_payments"))

    @cached_property
    def stg_expenses(self) -> DataFrame:
        return expenses.typed_expenses(self.source("fact_expenses"))

    @cached_property
    def mart_pnl_monthly(self) -> DataFrame:
        return expenses.pnl_monthly(self.stg_pnl, self.source("dim_city"))

    @cached_property
    def mart_payment_calendar(self) -> DataFrame:
        return expenses.payment_calendar(self.stg_payments)

    @cached_property
    def mart_unpaid(self) -> DataFrame:
        return expenses.unpaid(
            self.stg_payments, self.source("dim_counterparty"), self.source("dim_expense_category")
        )

    @cached_property
    def mart_expenses_detail(self) -> DataFrame:
        return expenses.expenses_detail(
            self.stg_expenses,
            self.source("dim_city"),
            self.source("dim_counterparty"),
            self.source("dim_expense_category"),
        )

    @cached_property
    def mart_expenses_no_category(self) -> DataFrame:
        return expenses.expenses_no_category(
            self.stg_expenses, self.source("dim_city"), self.source("dim_counterparty")
        )
