"""Data checks per table. A dimension is expected to meet what its clean table meets, and more."""

from __future__ import annotations

from finmarts.functions.rules import AGING_BUCKETS, SEGMENT_LABELS
from finmarts.operators.checks import Checks


def keyed(key: str | list[str], required: str = "", accepted: dict | None = None, **conditions: str) -> Checks:
    """Unique and filled keys, filled required columns, accepted codes and row conditions."""
    keys = [key] if isinstance(key, str) else key
    return Checks(
        not_null=[*keys, *required.split()], unique=keys, accepted=accepted or {}, conditions=conditions
    )


def plain(required: str = "", accepted: dict | None = None, **conditions: str) -> Checks:
    return Checks(not_null=required.split(), accepted=accepted or {}, conditions=conditions)


# Accepted codes.
STATEMENTS = {"statement_type": ["pl", "bs"]}
SEGMENTS = {"segment": list(SEGMENT_LABELS)}
SUPPLIER_STATUS = {"status": ["active", "inactive", "blocked"]}
BUCKETS = {"aging_bucket": AGING_BUCKETS}
INVOICE_TYPES = {"invoice_type": ["ar", "ap"]}
PERIOD_TYPES = {"period_type": ["week", "month", "quarter", "rolling_45d"]}

# Expectations by table.
EXPECTATIONS: dict[str, Checks] = {
    "stg_pnl": plain("month city_id revenue"),
    "stg_payments": plain("dt", {"is_paid": [0, 1]}),
    "stg_expenses": plain("dt amount"),
    "mart_pnl_monthly": plain("month city_name"),
    "ods_company": plain("company_id company_name inn founded_at"),
    "ods_warehouses": keyed("warehouse_id", "warehouse_code"),
    "ods_suppliers": keyed("supplier_id", "supplier_name", SUPPLIER_STATUS),
    "ods_clients": keyed("client_id", "client_name segment region", {"status": ["active", "inactive"], **SEGMENTS}),
    "ods_managers": keyed("manager_id", "full_name"),
    "ods_products": keyed(["product_id", "sku_code"], "category base_price purchase_price"),
    "ods_accounts": keyed(
        ["account_id", "account_code"],
        "account_name account_type",
        {
            **STATEMENTS,
            "normal_balance": ["debit", "credit"],
            "account_type": ["Asset", "Liability", "Equity", "Revenue", "Expense"],
        },
    ),
    "ods_purchase_orders": keyed(
        "po_id",
        "supplier_id po_date total_amount",
        {"status": ["delivered", "partial", "cancelled", "pending"]},
        po_amount_non_negative="total_amount >= 0",
    ),
    "ods_purchase_order_lines": keyed("po_line_id", "po_id product_id quantity unit_price"),
    "ods_sales_orders": keyed(
        "order_id",
        "client_id order_date total_amount",
        {"status": ["completed", "partial", "cancelled"], "payment_status": ["paid", "partial", "unpaid"]},
        so_amount_non_negative="total_amount >= 0",
    ),
    "ods_sales_order_lines": keyed("order_line_id", "order_id product_id quantity unit_price"),
    "ods_invoices": keyed("invoice_id", "invoice_type invoice_date amount", {**BUCKETS, **INVOICE_TYPES}),
    "ods_inventory_movements": keyed(
        "move_id",
        "product_id warehouse_id quantity move_date",
        {"move_type": ["receipt", "shipment", "writeoff", "adjustment"]},
    ),
    "ods_gl_postings": keyed(
        "gl_id",
        "posting_date account_id amount_base",
        {"scenario_id": [1, 2, 3]},
        gl_amount_non_negative="amount_base >= 0",
    ),
    "ods_marketing_spend": keyed(
        "spend_id",
        "platform spend_date spend_amount",
        spend_amount_non_negative="spend_amount >= 0",
        impressions_non_negative="impressions >= 0",
        clicks_non_negative="clicks >= 0",
    ),
    "dim_date": keyed(["date_id", "date_actual"]),
    "dim_company": keyed("company_id", "company_name inn"),
    "dim_warehouse": keyed("warehouse_id", "warehouse_code warehouse_name"),
    "dim_supplier": keyed(
        "supplier_id", "supplier_name", {**SUPPLIER_STATUS, "supplier_country_group": ["domestic", "foreign"]}
    ),
    "dim_client": keyed(
        "client_id", "client_name segment region", {"segment_label": list(SEGMENT_LABELS.values()), **SEGMENTS}
    ),
    "dim_manager": keyed("manager_id", "full_name"),
    "dim_product": keyed(["product_id", "sku_code"], "category base_price"),
    "dim_account": keyed(["account_id", "account_code"], "account_name account_type", STATEMENTS),
    "dim_channel": keyed("channel_id", "channel_code channel_name"),
    "dim_scenario": keyed("scenario_id", "scenario_code"),
    "fct_gl_entry": keyed(
        "gl_id", "posting_date account_id amount_base", gl_amount_non_negative="amount_base >= 0"
    ),
    "fct_sales_order_line": keyed(
        "order_line_id",
        "order_id order_date client_id product_id quantity line_revenue",
        line_revenue_non_negative="line_revenue >= 0",
        quantity_positive="quantity > 0",
    ),
    "fct_purchase_order_line": keyed(
        "po_line_id",
        "po_id po_date supplier_id product_id quantity",
        quantity_positive="quantity > 0",
        line_amount_non_negative="line_amount >= 0",
    ),
    "fct_invoice": keyed(
        "invoice_id",
        "invoice_date invoice_type amount",
        {**BUCKETS, **INVOICE_TYPES},
        amount_non_negative="amount >= 0",
        outstanding_non_negative="outstanding >= 0",
    ),
    "fct_marketing_spend": keyed(
        "spend_id",
        "spend_date spend_amount",
        spend_amount_non_negative="spend_amount >= 0",
        impressions_non_negative="impressions >= 0",
    ),
    "dm_pnl_periodic": plain("period_type period_start scenario_id revenue", PERIOD_TYPES),
    "dm_balance_monthly": plain("period scenario_id total_assets", balance_equation="abs(balance_diff) < 100"),
    "dm_cashflow_monthly": plain("period scenario_id net_cash_flow"),
    "dm_exec_kpi_monthly": plain("period scenario_id revenue net_profit total_assets"),
    "dm_sales_marketing_periodic": plain("period_type period_start revenue", PERIOD_TYPES),
    "dm_working_capital_monthly": plain("period invoice_type total_invoiced"),
    "dm_ar_ap_aging_snapshot": keyed(
        "invoice_id", "invoice_type aging_bucket outstanding", open_invoices_only="outstanding > 0"
    ),
}
