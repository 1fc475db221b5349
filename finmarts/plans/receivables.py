"""Receivables and payables: working capital by month and the aging snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from finmarts.functions import calendar as cal, rules
from finmarts.functions.numeric import percent, sum_if, sum_total

BUCKET_COLUMNS = ["bucket_current", "bucket_1_30", "bucket_31_60", "bucket_61_90", "bucket_90plus"]
COLUMNS = [
    "period", "year", "quarter", "month", "invoice_type", "counterparty_segment", "invoice_count",
    "total_invoiced", "total_paid", "total_outstanding", "collection_rate_pct", *BUCKET_COLUMNS,
    "avg_days_overdue", "overdue_invoice_count", "overdue_pct", "outstanding_ar", "outstanding_ap",
]


def working_capital_monthly(invoices: DataFrame) -> DataFrame:
    """Invoiced, paid and open amounts per month, type and segment, with aging buckets."""
    day = F.col("invoice_date")
    totals = invoices.groupBy(
        cal.month_start(day).alias("period"), "invoice_type", "counterparty_segment"
    ).agg(
        F.count("invoice_id").alias("invoice_count"),
        sum_total("amount").alias("total_invoiced"),
        sum_total("paid_amount").alias("total_paid"),
        sum_total("outstanding").alias("total_outstanding"),
        *[
            sum_if("outstanding", F.col("aging_bucket") == bucket).alias(name)
            for name, bucket in zip(BUCKET_COLUMNS, rules.AGING_BUCKETS)
        ],
        F.avg("days_overdue").alias("avg_days_overdue"),
        F.count_if(F.col("is_overdue") == 1).alias("overdue_invoice_count"),
        *[
            sum_if("outstanding", F.col("invoice_type") == kind).alias(f"outstanding_{kind}")
            for kind in ("ar", "ap")
        ],
    )
    return totals.withColumns({
        "year": F.year("period"),
        "quarter": F.quarter("period"),
        "month": F.month("period"),
        "collection_rate_pct": percent("total_paid", "total_invoiced"),
        "overdue_pct": percent("overdue_invoice_count", "invoice_count"),
    }).select(*COLUMNS)


def open_invoices(invoices: DataFrame) -> DataFrame:
    return invoices.where(F.col("outstanding") > 0)


def aging_snapshot(invoices: DataFrame, as_of: dt.date) -> DataFrame:
    """Open invoices with their risk level on the snapshot day."""
    return open_invoices(invoices).select(
        "invoice_id",
        "invoice_code",
        "invoice_type",
        "invoice_date",
        "due_date",
        "days_overdue",
        "aging_bucket",
        "counterparty_id",
        "counterparty_name",
        "counterparty_type",
        "counterparty_segment",
        "counterparty_region",
        "amount",
        "paid_amount",
        "outstanding",
        "collection_rate",
        rules.risk_level(F.col("aging_bucket")).alias("risk_level"),
        F.lit(as_of).alias("snapshot_date"),
    )
