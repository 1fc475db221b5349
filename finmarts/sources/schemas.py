"""Schemas of the source tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the seed files.
SEEDS = {
    "dim_city": "city_id int, city_name string",
    "dim_counterparty": "cp_id bigint, cp_name string, cp_type string",
    "dim_expense_category": "cat_id bigint, group_name string, group_stat string, stat_name string",
    "dim_date": "dt date, week date, month date, quarter int, year int, month_name string",
    "fact_expenses": (
        "dt date, city_id int, cp_id bigint, cat_id bigint, doc_number bigint, mc_flag int, "
        "item_name string, amount double, has_category int"
    ),
    "fact_payments": (
        "dt date, city_id int, cp_id bigint, cat_id bigint, doc_number bigint, planned_sales double, "
        "amount_to_pay double, balance double, is_paid int, due_date date"
    ),
    "fact_pnl": (
        "month date, city_id int, cat_id bigint, revenue double, cogs double, gross_profit double, "
        "operating_cost double, ebitda double, net_profit double, tax double"
    ),
}

# Load columns present on every staging table.
LOAD_COLUMNS = "_row_hash string, _source_system string, _batch_id string, _ingested_at date, _is_deleted int"

# Business columns of the staging tables; the first one is the key.
STAGING = {
    "stg_company": (
        "company_id bigint, company_name string, company_short string, inn string, kpp string, "
        "legal_address string, industry string, base_currency string, fiscal_year_start_month int, "
        "founded_at date"
    ),
    "stg_warehouses": (
        "warehouse_id bigint, warehouse_code string, warehouse_name string, address string, "
        "region string, is_active int"
    ),
    "stg_suppliers": (
        "supplier_id bigint, supplier_name string, supplier_code string, country_code string, "
        "payment_terms_days int, credit_limit decimal(18,2), status string"
    ),
    "stg_clients": (
        "client_id bigint, client_name string, client_code string, client_type string, segment string, "
        "region string, inn string, payment_terms_days int, credit_limit decimal(18,2), "
        "assigned_manager_id bigint, warehouse_id bigint, status string, registered_at date"
    ),
    "stg_managers": (
        "manager_id bigint, full_name string, department string, region string, hire_date date, status string"
    ),
    "stg_products": (
        "product_id bigint, sku_code string, product_name string, brand string, category string, "
        "subcategory string, unit_of_measure string, pack_size string, base_price decimal(18,2), "
        "purchase_price decimal(18,2), vat_rate double, min_order_qty bigint, supplier_id bigint, "
        "warehouse_id bigint, is_active int, launched_at date"
    ),
    "stg_accounts": (
        "account_id bigint, account_code string, account_name string, account_type string, "
        "statement_type string, bs_group string, cf_section string, pl_group string, pl_sign int, "
        "is_monetary int, normal_balance string"
    ),
    "stg_purchase_orders": (
        "po_id bigint, po_code string, supplier_id bigint, warehouse_id bigint, po_date date, "
        "expected_delivery date, actual_delivery string, status string, currency_code string, "
        "total_amount decimal(18,2)"
    ),
    "stg_purchase_order_lines": (
        "po_line_id bigint, po_id bigint, product_id bigint, sku_code string, category string, "
        "quantity bigint, unit_price decimal(18,2), line_amount decimal(18,2), received_qty bigint"
    ),
    "stg_sales_orders": (
        "order_id bigint, order_code string, client_id bigint, manager_id bigint, warehouse_id bigint, "
        "order_date date, shipment_date date, status string, payment_status string, currency_code string, "
        "discount_pct decimal(18,4), total_amount decimal(18,2)"
    ),
    "stg_sales_order_lines": (
        "order_line_id bigint, order_id bigint, product_id bigint, sku_code string, category string, "
        "brand string, quantity bigint, unit_price decimal(18,2), unit_cost decimal(18,2), "
        "line_revenue decimal(18,2), line_cogs decimal(18,2), line_gross_profit decimal(18,2)"
    ),
    "stg_invoices": (
        "invoice_id bigint, invoice_code string, invoice_type string, counterparty_id bigint, "
        "counterparty_type string, order_id bigint, invoice_date date, due_date date, "
        "currency_code string, amount decimal(18,2), paid_amount decimal(18,2), "
        "outstanding decimal(18,2), days_overdue int, status string"
    ),
    "stg_inventory_movements": (
        "move_id bigint, move_type string, reference_type string, reference_id bigint, "
        "product_id bigint, warehouse_id bigint, quantity int, unit_cost decimal(18,2), move_date date"
    ),
    "stg_gl_postings": (
        "gl_id bigint, posting_date date, doc_type string, account_id bigint, contra_account_id bigint, "
        "amount_base decimal(18,2), currency_code string, description string, scenario_id int"
    ),
    "stg_marketing_spend": (
        "spend_id bigint, campaign_id string, campaign_name string, platform string, spend_date date, "
        "impressions bigint, clicks bigint, conversions bigint, spend_amount decimal(18,2), "
        "currency_code string"
    ),
}


def schema_of(table: str) -> T.StructType:
    """Declared schema of a seed or staging table."""
    if table in SEEDS:
        return T.StructType.fromDDL(SEEDS[table])
    return T.StructType.fromDDL(f"{STAGING[table]}, {LOAD_COLUMNS}")
