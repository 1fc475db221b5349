"""Clean layer: typed, trimmed, deduplicated source rows with derived columns and quality flags.

Every function takes the staging table and returns one row per live key, except the
company and account lists, which are kept as delivered. Columns that depend on the
current day take ``as_of`` instead of the clock.

Tables that can be large take the step that keeps one row per key as ``keep``, and columns to pass on as ``also``, so
that `finmarts.operators.checks.run_newest_checks` can look at cleaned rows before that step.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from finmarts.functions import calendar as cal, rules
from finmarts.functions.numeric import FRACTION, MONEY, flag, money, percent, safe_ratio
from finmarts.functions.rules import code, day, text
from finmarts.operators.latest import Keep, latest_live


def _id(name: str):
    return F.col(name).cast("long").alias(name)


def _int(name: str):
    return F.col(name).cast("int").alias(name)


def _money(name: str):
    return money(name).alias(name)


def _text(*names: str):
    return [text(n).alias(n) for n in names]


def _code(*names: str):
    return [code(n).alias(n) for n in names]


def _day(*names: str):
    return [day(n).alias(n) for n in names]


def company(stg: DataFrame) -> DataFrame:
    start = F.col("fiscal_year_start_month").cast("int")
    return stg.where(F.col("_is_deleted") == 0).select(
        _id("company_id"),
        *_text("company_name", "company_short", "inn", "kpp", "legal_address", "industry", "base_currency"),
        start.alias("fiscal_year_start_month"),
        rules.fiscal_year_end(start).alias("fiscal_year_end_month"),
        *_day("founded_at"),
    )


def accounts(stg: DataFrame) -> DataFrame:
    """Chart of accounts, one row per account; group codes come out in one spelling whatever the source uses."""
    typed = latest_live(stg, ["account_id"]).select(
        _id("account_id"),
        *_code("account_code"),
        *_text("account_name", "account_type"),
        *_code("statement_type"),
        rules.group_code("bs_group").alias("bs_group"),
        *_text("cf_section"),
        rules.group_code("pl_group").alias("pl_group"),
        _int("pl_sign"),
        _int("is_monetary"),
        *_code("normal_balance"),
    )
    return typed.select(
        "*",
        flag(F.col("statement_type").isin("pl", "bs")).alias("dq_valid_stmt_type"),
        rules.label(F.col("pl_group"), rules.PL_GROUP_LABELS).alias("pl_group_label"),
        rules.label(F.col("bs_group"), rules.BS_GROUP_LABELS).alias("bs_group_label"),
    )


def clients(stg: DataFrame, as_of: dt.date) -> DataFrame:
    typed = latest_live(stg, ["client_id"]).select(
        _id("client_id"),
        *_text("client_name"),
        *_code("client_code", "client_type"),
        *_text("segment", "region", "inn"),
        _int("payment_terms_days"),
        _money("credit_limit"),
        _id("assigned_manager_id"),
        _id("warehouse_id"),
        *_code("status"),
        *_day("registered_at"),
    )
    return typed.select(
        "*",
        rules.label(F.col("segment"), rules.SEGMENT_LABELS).alias("segment_label"),
        F.date_diff(F.lit(as_of), "registered_at").alias("days_since_registration"),
        flag(F.col("assigned_manager_id") > 0).alias("dq_has_manager"),
    )


def managers(stg: DataFrame, as_of: dt.date) -> DataFrame:
    typed = latest_live(stg, ["manager_id"]).select(
        _id("manager_id"), *_text("full_name", "department", "region"), *_day("hire_date"), *_code("status")
    )
    tenure = F.date_diff(F.lit(as_of), "hire_date")
    return typed.select("*", tenure.alias("tenure_days"), rules.tenure_group(tenure).alias("tenure_group"))


def products(stg: DataFrame) -> DataFrame:
    typed = latest_live(stg, ["product_id"]).select(
        _id("product_id"),
        *_code("sku_code"),
        *_text("product_name", "brand", "category", "subcategory", "unit_of_measure", "pack_size"),
        _money("base_price"),
        _money("purchase_price"),
        F.col("vat_rate").cast("double").alias("vat_rate"),
        _id("min_order_qty"),
        _id("supplier_id"),
        _id("warehouse_id"),
        _int("is_active"),
        *_day("launched_at"),
    )
    margin = rules.margin_percent(F.col("base_price"), F.col("purchase_price"))
    priced = typed.select("*", margin.alias("margin_pct"))
    return priced.select(
        "*",
        rules.margin_group(F.col("margin_pct")).alias("margin_group"),
        rules.price_with_vat(F.col("base_price"), F.col("vat_rate")).alias("price_with_vat"),
    )


def suppliers(stg: DataFrame) -> DataFrame:
    return latest_live(stg, ["supplier_id"]).select(
        _id("supplier_id"),
        *_text("supplier_name"),
        *_code("supplier_code"),
        *_text("country_code"),
        _int("payment_terms_days"),
        _money("credit_limit"),
        *_code("status"),
        F.when(text("country_code") == "RU", "domestic").otherwise("foreign").alias("supplier_country_group"),
    )


def warehouses(stg: DataFrame) -> DataFrame:
    return latest_live(stg, ["warehouse_id"]).select(
        _id("warehouse_id"),
        *_code("warehouse_code"),
        *_text("warehouse_name", "address", "region"),
        _int("is_active"),
        F.when(F.col("warehouse_id") == 1, "primary").otherwise("secondary").alias("warehouse_tier"),
    )


def purchase_orders(stg: DataFrame, keep: Keep = latest_live, also: Sequence[Column] = ()) -> DataFrame:
    typed = keep(stg, ["po_id"]).select(
        _id("po_id"),
        *_text("po_code"),
        _id("supplier_id"),
        _id("warehouse_id"),
        *_day("po_date", "expected_delivery", "actual_delivery"),
        *_code("status"),
        *_text("currency_code"),
        _money("total_amount"),
        *also,
    )
    delay = F.date_diff("actual_delivery", "expected_delivery")
    delivered = F.col("actual_delivery")
    return typed.select(
        "*",
        delay.alias("delivery_delay_days"),
        rules.on_time(delay, delivered).alias("is_on_time"),
        flag(delivered.isNotNull()).alias("dq_has_delivery"),
    )


def purchase_order_lines(stg: DataFrame, keep: Keep = latest_live, also: Sequence[Column] = ()) -> DataFrame:
    typed = keep(stg, ["po_line_id"]).select(
        _id("po_line_id"),
        _id("po_id"),
        _id("product_id"),
        *_code("sku_code"),
        *_text("category"),
        _id("quantity"),
        _money("unit_price"),
        _money("line_amount"),
        _id("received_qty"),
        *also,
    )
    return typed.select(
        "*",
        percent("received_qty", "quantity", 1).alias("receipt_pct"),
        flag(F.col("received_qty") > F.col("quantity")).alias("dq_qty_mismatch"),
    )


def sales_orders(stg: DataFrame, keep: Keep = latest_live, also: Sequence[Column] = ()) -> DataFrame:
    typed = keep(stg, ["order_id"]).select(
        _id("order_id"),
        *_text("order_code"),
        _id("client_id"),
        _id("manager_id"),
        _id("warehouse_id"),
        *_day("order_date", "shipment_date"),
        *_code("status", "payment_status"),
        *_text("currency_code"),
        F.col("discount_pct").cast(FRACTION).alias("discount_pct"),
        _money("total_amount"),
        *also,
    )
    ordered = F.col("order_date")
    return typed.select(
        "*",
        cal.month_start(ordered).alias("order_month"),
        F.year(ordered).alias("order_year"),
        F.quarter(ordered).alias("order_quarter"),
        cal.iso_weekday(ordered).alias("day_of_week"),
        flag(cal.iso_weekday(ordered) >= 6).alias("is_weekend"),
        F.date_diff("shipment_date", "order_date").alias("shipment_lag_days"),
        flag(F.col("total_amount") > 0).alias("dq_valid_amount"),
    )


def sales_order_lines(stg: DataFrame, keep: Keep = latest_live, also: Sequence[Column] = ()) -> DataFrame:
    typed = keep(stg, ["order_line_id"]).select(
        _id("order_line_id"),
        _id("order_id"),
        _id("product_id"),
        *_code("sku_code"),
        *_text("category", "brand"),
        _id("quantity"),
        *[_money(c) for c in ("unit_price", "unit_cost", "line_revenue", "line_cogs", "line_gross_profit")],
        *also,
    )
    return typed.select(
        "*",
        percent("line_gross_profit", "line_revenue").alias("gross_margin_pct"),
        flag(F.col("line_gross_profit") < 0).alias("dq_negative_margin"),
        flag(F.col("unit_price") == 0).alias("dq_zero_price"),
    )


def invoices(stg: DataFrame, keep: Keep = latest_live, also: Sequence[Column] = ()) -> DataFrame:
    typed = keep(stg, ["invoice_id"]).select(
        _id("invoice_id"),
        *_text("invoice_code"),
        *_code("invoice_type"),
        _id("counterparty_id"),
        *_code("counterparty_type"),
        _id("order_id"),
        *_day("invoice_date", "due_date"),
        *_text("currency_code"),
        _money("amount"),
        _money("paid_amount"),
        _money("outstanding"),
        _int("days_overdue"),
        *_code("status"),
        *also,
    )
    return typed.select(
        "*",
        rules.aging_bucket(F.col("days_overdue")).alias("aging_bucket"),
        percent("paid_amount", "amount", 1).alias("collection_rate"),
        rules.is_overdue(F.col("days_overdue"), F.col("outstanding")).alias("is_overdue"),
    )


def inventory_movements(stg: DataFrame, keep: Keep = latest_live, also: Sequence[Column] = ()) -> DataFrame:
    typed = keep(stg, ["move_id"]).select(
        _id("move_id"),
        *_code("move_type", "reference_type"),
        _id("reference_id"),
        _id("product_id"),
        _id("warehouse_id"),
        _int("quantity"),
        _money("unit_cost"),
        *_day("move_date"),
        *also,
    )
    return typed.select(
        "*",
        F.round(F.col("quantity") * F.col("unit_cost"), 2).cast(MONEY).alias("movement_value"),
        F.when(F.col("quantity") > 0, "in").otherwise("out").alias("move_direction"),
        flag(F.col("unit_cost") == 0).alias("dq_zero_cost"),
    )


def marketing_spend(stg: DataFrame, keep: Keep = latest_live, also: Sequence[Column] = ()) -> DataFrame:
    typed = keep(stg, ["spend_id"]).select(
        _id("spend_id"),
        *_text("campaign_id", "campaign_name", "platform"),
        *_day("spend_date"),
        _id("impressions"),
        _id("clicks"),
        _id("conversions"),
        _money("spend_amount"),
        *_text("currency_code"),
        *also,
    )
    return typed.select(
        "*",
        percent("clicks", "impressions", 3).alias("ctr"),
        percent("conversions", "clicks", 3).alias("conversion_rate"),
        safe_ratio("spend_amount", "clicks").alias("cpc"),
        safe_ratio("spend_amount", "conversions").alias("cpa"),
        cal.month_start(F.col("spend_date")).alias("spend_month"),
        flag(F.col("spend_amount") == 0).alias("dq_zero_spend"),
    )


def gl_postings(
    stg: DataFrame, accounts: DataFrame, keep: Keep = latest_live, also: Sequence[Column] = ()
) -> DataFrame:
    """Ledger postings with the statement attributes of their account (null where unknown)."""
    typed = keep(stg, ["gl_id"]).select(
        _id("gl_id"),
        *_day("posting_date"),
        *_text("doc_type"),
        _id("account_id"),
        _id("contra_account_id"),
        _money("amount_base"),
        *_text("currency_code", "description"),
        _int("scenario_id"),
        *also,
    )
    attributes = ["statement_type", "pl_group", "pl_sign", "bs_group", "cf_section", "is_monetary", "normal_balance"]
    known = accounts.select(
        F.col("account_id").alias("_known_account"), *attributes
    )
    posted = F.col("posting_date")
    return typed.join(known, F.col("account_id") == F.col("_known_account"), "left").select(
        *typed.columns,
        *attributes,
        rules.signed_amount(F.col("amount_base"), F.col("pl_sign")).alias("signed_amount"),
        cal.month_start(posted).alias("posting_month"),
        F.year(posted).alias("posting_year"),
        flag(F.col("_known_account").isNull()).alias("dq_missing_account"),
    )
