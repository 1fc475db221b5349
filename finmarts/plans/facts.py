"""Fact tables: one row per posting, invoice, spend record and order line.

The lookup sides are unique by key. None is broadcast by hint: Spark decides from
their size, and large ones join by shuffle with hot keys split at run time.
The date key is computed (see ``date_key``), so no fact joins the date dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from finmarts.functions import calendar as cal
from finmarts.functions.calendar import CalendarRange, date_key
from finmarts.functions.numeric import flag


def gl_entry(postings: DataFrame, calendar: CalendarRange) -> DataFrame:
    """Ledger entries. The account attributes were joined when the postings were cleaned."""
    posted = F.col("posting_date")
    return postings.select(
        "gl_id",
        date_key(posted, calendar).alias("date_id"),
        "posting_date",
        "posting_month",
        "account_id",
        "contra_account_id",
        "scenario_id",
        "doc_type",
        "description",
        "statement_type",
        "pl_group",
        "pl_sign",
        "bs_group",
        "cf_section",
        "is_monetary",
        "normal_balance",
        "amount_base",
        "signed_amount",
    )


def counterparties(clients: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Clients and suppliers as one list keyed by (type, id), so an invoice needs one join, not two."""
    as_client = clients.select(
        F.lit("client").alias("counterparty_type"),
        F.col("client_id").alias("counterparty_id"),
        F.col("client_name").alias("_name"),
        F.col("segment").alias("counterparty_segment"),
        F.col("region").alias("counterparty_region"),
    )
    as_supplier = suppliers.select(
        F.lit("supplier").alias("counterparty_type"),
        F.col("supplier_id").alias("counterparty_id"),
        F.col("supplier_name").alias("_name"),
        F.lit(None).cast("string").alias("counterparty_segment"),
        F.lit(None).cast("string").alias("counterparty_region"),
    )
    return as_client.unionByName(as_supplier)


def invoice(invoices: DataFrame, clients: DataFrame, suppliers: DataFrame, calendar: CalendarRange) -> DataFrame:
    parties = counterparties(clients, suppliers)
    return invoices.join(parties, ["counterparty_type", "counterparty_id"], "left").select(
        "invoice_id",
        "invoice_code",
        date_key(F.col("invoice_date"), calendar).alias("date_id"),
        "invoice_date",
        "due_date",
        cal.month_start(F.col("invoice_date")).alias("invoice_month"),
        "invoice_type",
        "counterparty_id",
        "counterparty_type",
        F.coalesce("_name", F.lit("Unknown")).alias("counterparty_name"),
        "counterparty_segment",
        "counterparty_region",
        "amount",
        "paid_amount",
        "outstanding",
        "days_overdue",
        "collection_rate",
        "aging_bucket",
        "is_overdue",
        "status",
    )


def marketing_spend(spend: DataFrame, calendar: CalendarRange) -> DataFrame:
    day = F.col("spend_date")
    return spend.select(
        "spend_id",
        date_key(day, calendar).alias("date_id"),
        "spend_date",
        "spend_month",
        F.year(day).alias("spend_year"),
        F.quarter(day).alias("spend_quarter"),
        F.col("campaign_id").cast("long").alias("campaign_id"),
        "campaign_name",
        F.lit("unknown").alias("campaign_type"),
        "platform",
        "impressions",
        "clicks",
        "conversions",
        "spend_amount",
        "ctr",
        "conversion_rate",
        "cpc",
        "cpa",
    )


def purchase_order_line(
    lines: DataFrame, orders: DataFrame, suppliers: DataFrame, products: DataFrame, calendar: CalendarRange
) -> DataFrame:
    """Purchase lines with their order, supplier and product; the warehouse adds no column."""
    header = orders.select(
        "po_id", "po_date", "supplier_id", "warehouse_id", F.col("status").alias("po_status"), "is_on_time"
    )
    supplier = suppliers.select("supplier_id", "supplier_name", "supplier_country_group")
    product = products.select(
        "product_id", F.col("category").alias("product_category"), F.col("brand").alias("product_brand")
    )
    # the supplier belongs to the order: attaching it to the header spares a join of the lines
    header = header.join(supplier, "supplier_id", "left")
    rows = lines.drop("category").join(header, "po_id").join(product, "product_id", "left")
    return rows.select(
        "po_line_id",
        "po_id",
        date_key(F.col("po_date"), calendar).alias("date_id"),
        "po_date",
        cal.month_start(F.col("po_date")).alias("po_month"),
        "supplier_id",
        "warehouse_id",
        "product_id",
        "supplier_name",
        "supplier_country_group",
        "product_category",
        "product_brand",
        "quantity",
        "received_qty",
        "unit_price",
        "line_amount",
        "receipt_pct",
        "po_status",
        flag(F.col("is_on_time") == 1).alias("is_on_time"),
    )


def sales_order_line(
    lines: DataFrame, orders: DataFrame, clients: DataFrame, products: DataFrame, calendar: CalendarRange
) -> DataFrame:
    """Sales lines with their order, client and product; manager and warehouse add no column."""
    header = orders.select(
        "order_id", "order_date", "client_id", "manager_id", "warehouse_id", "discount_pct",
        F.col("status").alias("order_status"), "payment_status",
    )
    client = clients.select(
        "client_id", F.col("segment").alias("client_segment"), F.col("region").alias("client_region")
    )
    product = products.select(
        "product_id", F.col("category").alias("product_category"), F.col("brand").alias("product_brand"),
        "margin_group",
    )
    # the client belongs to the order: attaching it to the header spares a join of the lines
    header = header.join(client, "client_id", "left")
    rows = lines.drop("category", "brand").join(header, "order_id").join(product, "product_id", "left")
    day = F.col("order_date")
    return rows.select(
        "order_line_id",
        "order_id",
        date_key(day, calendar).alias("date_id"),
        "order_date",
        cal.month_start(day).alias("order_month"),
        F.year(day).alias("order_year"),
        F.quarter(day).alias("order_quarter"),
        "client_id",
        "manager_id",
        "warehouse_id",
        "product_id",
        F.lit(1).alias("scenario_id"),
        "client_segment",
        "client_region",
        "product_category",
        "product_brand",
        "margin_group",
        "quantity",
        "unit_price",
        "unit_cost",
        "discount_pct",
        "line_revenue",
        "line_cogs",
        "line_gross_profit",
        "gross_margin_pct",
        "order_status",
        "payment_status",
    )
