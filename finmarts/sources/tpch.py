"""ERP and register source tables derived from the provided TPC-H-like tables.

The provided tables carry no ledger, invoices or clean/dirty codes, so each source
table is a projection of one of them (plus the nation and region names). Codes get
stray blanks and mixed case, some dates are blank, order lines repeat their key as
they do in the data, and dimension rows come in two load versions, some of them
deleted, so that every cleaning rule has work to do.

The statements use only SQL that other engines run too, apart from ``{versions}``;
the correctness check builds the same inputs from them.
"""

from __future__ import annotations

import os
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from finmarts.sources.readers import Source
from finmarts.sources.schemas import schema_of

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

#: Load versions of a dimension row: every third key was loaded twice.
SPARK_VERSIONS = "explode(if({key} % 3 = 0, array(0, 1), array(0)))"


def _load(system: str, row_hash: str, batch: str, ingested: str, deleted: str = "0") -> str:
    return f"""{row_hash} as _row_hash, '{system}' as _source_system, {batch} as _batch_id,
        {ingested} as _ingested_at, {deleted} as _is_deleted"""


def _versioned(system: str, table: str, key: str) -> str:
    """Load columns of a two-version dimension row; every ninth key's newer version is a deletion."""
    return _load(
        system,
        f"md5(concat_ws('|', '{table}', cast({key} as string), cast(v as string)))",
        "concat('batch_', cast(v as string))",
        "date '2001-07-01' + v",
        f"case when v = 1 and {key} % 9 = 0 then 1 else 0 end",
    )


_RENAMED = "case when v = 1 then ' (renamed) ' else ' ' end"
_LINE_HASH = """md5(concat_ws('|', cast(l_orderkey as string), cast(l_linenumber as string),
        cast(l_partkey as string), cast(l_suppkey as string), cast(cast(l_quantity as int) as string),
        cast(cast(floor(l_extendedprice * 100 + 0.5) as bigint) as string),
        cast(cast(floor(l_discount * 100 + 0.5) as int) as string),
        cast(cast(floor(l_tax * 100 + 0.5) as int) as string), l_returnflag, l_linestatus,
        cast(cast(l_shipdate as date) as string)))"""
_LINE_LOAD = _load(
    "ERP",
    _LINE_HASH,
    "concat('batch_', lpad(cast(l_suppkey as string), 8, '0'))",
    "cast(l_shipdate as date)",
    "case when l_quantity = 50 and l_returnflag = 'A' then 1 else 0 end",
)
_LINE_KEY = "l_orderkey * 8 + l_linenumber"
_PRICE = "cast(l_extendedprice as decimal(18,2))"
_REVENUE = f"cast({_PRICE} * (1 - cast(l_discount as decimal(4,2))) as decimal(18,2))"
_HUNDREDTH = "cast(0.01 as decimal(3,2))"
_COST_RATE = f"cast(55 + 15 * (l_partkey % 4) as decimal(5,0)) * {_HUNDREDTH}"
_LINE_COGS = f"cast({_PRICE} * ({_COST_RATE}) as decimal(18,2))"
_UNIT_PRICE = f"cast(cast(floor(cast({_PRICE} * 100 as bigint) / l_quantity) as decimal(18,0)) * {_HUNDREDTH} as decimal(18,2))"
_OPERATING_COST = "cast(cast(l_quantity as decimal(18,0)) * cast(12.5 as decimal(4,1)) as decimal(18,2))"
_ORDER_LOAD = _load(
    "ERP",
    "md5(concat_ws('|', 'order', cast(o_orderkey as string)))",
    "concat('batch_', lpad(cast(o_custkey as string), 8, '0'))",
    "cast(o_orderdate as date)",
)
_ORDER_TOTAL = "cast(o_totalprice as decimal(18,2))"
_HALF_TOTAL = f"cast(cast(floor(cast({_ORDER_TOTAL} * 100 as bigint) / 2) as decimal(18,0)) * {_HUNDREDTH} as decimal(18,2))"
_HALF_PRICE = f"cast(cast(floor(cast({_PRICE} * 100 as bigint) / 2) as decimal(18,0)) * {_HUNDREDTH} as decimal(18,2))"

STATEMENTS: dict[str, str] = {
    "stg_company": f"""
    select cast(r_regionkey + 1 as bigint) as company_id, concat(' ', r_name, ' Trading ') as company_name,
        concat(r_name, ' ') as company_short, concat('10', lpad(cast(r_regionkey as string), 8, '5')) as inn,
        '100000001' as kpp, concat(r_name, ', 1') as legal_address, 'Wholesale' as industry,
        ' RUB' as base_currency, cast(r_regionkey * 2 + 1 as int) as fiscal_year_start_month,
        date '1990-01-01' + cast(r_regionkey * 400 as int) as founded_at,
        {_load("1C", "md5(r_name)", "'batch_0001'", "date '2001-07-01'",
               "case when r_regionkey = 4 then 1 else 0 end")}
    from {{region}}""",
    "stg_warehouses": f"""
    select cast(n_nationkey + 1 as bigint) as warehouse_id, concat(' WH-', n_name) as warehouse_code,
        concat(' ', n_name, {_RENAMED}) as warehouse_name, concat('Street ', cast(n_nationkey as string)) as address,
        concat(r_name, ' ') as region, cast(case when n_nationkey % 5 = 0 then 0 else 1 end as int) as is_active,
        {_versioned("1C", "warehouse", "n_nationkey")}
    from (select *, {{versions_n_nationkey}} as v from {{nation}}) as n
    join {{region}} as r on r_regionkey = n_regionkey""",
    "stg_suppliers": f"""
    select s_suppkey as supplier_id, concat(' ', s_name, {_RENAMED}) as supplier_name,
        concat(' SUP', cast(s_suppkey as string)) as supplier_code,
        case when s_nationkey = 0 then ' RU' else concat('N', cast(s_nationkey as string)) end as country_code,
        cast(30 + 15 * (s_suppkey % 4) as int) as payment_terms_days,
        cast(s_acctbal as decimal(18,2)) as credit_limit,
        case when s_acctbal < 0 then ' Blocked' when s_suppkey % 10 = 0 then 'Inactive' else 'Active ' end as status,
        {_versioned("1C", "supplier", "s_suppkey")}
    from (select *, {{versions_s_suppkey}} as v from {{supplier}}) as s""",
    "stg_clients": f"""
    select c_custkey as client_id, concat(' ', c_name, {_RENAMED}) as client_name,
        concat('CLI', cast(c_custkey as string), ' ') as client_code, concat(' ', c_mktsegment) as client_type,
        case when c_mktsegment in ('AUTOMOBILE', 'BUILDING') then ' A'
            when c_mktsegment in ('FURNITURE', 'HOUSEHOLD') then 'B ' else 'C' end as segment,
        concat(r_name, ' ') as region, lpad(cast(c_custkey as string), 10, '0') as inn,
        cast(7 + 7 * (c_custkey % 5) as int) as payment_terms_days,
        cast(c_acctbal as decimal(18,2)) as credit_limit, c_custkey % 11 as assigned_manager_id,
        cast(c_nationkey + 1 as bigint) as warehouse_id,
        case when c_acctbal < 0 then ' Inactive' else 'ACTIVE' end as status,
        date '1990-01-01' + cast(c_custkey % 1500 as int) as registered_at,
        {_versioned("CRM", "client", "c_custkey")}
    from (select *, {{versions_c_custkey}} as v from {{customer}}) as c
    join {{nation}} as n on n_nationkey = c_nationkey
    join {{region}} as r on r_regionkey = n_regionkey""",
    "stg_managers": f"""
    select cast(n_nationkey + 1 as bigint) as manager_id, concat(' Manager ', n_name, {_RENAMED}) as full_name,
        concat('Department ', cast(n_nationkey % 3 as string)) as department, concat(r_name, ' ') as region,
        date '1995-01-01' + cast(n_nationkey * 97 as int) as hire_date, ' Active' as status,
        {_versioned("HR", "manager", "n_nationkey")}
    from (select *, {{versions_n_nationkey}} as v from {{nation}}) as n
    join {{region}} as r on r_regionkey = n_regionkey""",
    "stg_products": f"""
    select p_partkey as product_id, concat(' SKU', cast(p_partkey as string)) as sku_code,
        concat(' ', p_name, {_RENAMED}) as product_name, concat(p_brand, ' ') as brand, p_type as category,
        p_brand as subcategory, 'pcs' as unit_of_measure, cast(p_size as string) as pack_size,
        cast(p_retailprice as decimal(18,2)) as base_price,
        cast(cast(p_retailprice as decimal(18,2)) * (cast(70 + 7 * (p_partkey % 4) as decimal(5,0)) * {_HUNDREDTH})
            as decimal(18,2)) as purchase_price,
        cast(0.2 as double) as vat_rate, cast(1 + p_size % 12 as bigint) as min_order_qty,
        p_partkey % 100 as supplier_id, p_partkey % 25 + 1 as warehouse_id,
        cast(case when p_size % 4 = 0 then 0 else 1 end as int) as is_active,
        date '1995-01-01' + cast(p_partkey % 1000 as int) as launched_at,
        {_versioned("ERP", "product", "p_partkey")}
    from (select *, {{versions_p_partkey}} as v from {{part}}) as p""",
    "stg_accounts": f"""
    select cast(n_nationkey + 1 as bigint) as account_id, concat(' ACC-', n_name) as account_code,
        concat(n_name, {_RENAMED}) as account_name,
        case when n_nationkey < 15 and n_nationkey % 6 = 0 then 'Revenue' when n_nationkey < 15 then 'Expense'
            when n_nationkey % 5 in (0, 1) then 'Asset' when n_nationkey % 5 in (2, 3) then 'Liability'
            else 'Equity' end as account_type,
        case when n_nationkey < 15 then ' PL' else 'BS ' end as statement_type,
        case when n_nationkey < 15 then null when n_nationkey % 5 = 0 then 'Current_Assets'
            when n_nationkey % 5 = 1 then 'Non_Current_Assets' when n_nationkey % 5 = 2 then 'Current_Liabilities'
            when n_nationkey % 5 = 3 then 'noncurrent_liabilities ' else 'Equity' end as bs_group,
        case when n_nationkey % 4 = 0 then 'Operating' when n_nationkey % 4 = 1 then ' Financing' else '' end
            as cf_section,
        case when n_nationkey >= 15 then null when n_nationkey % 6 = 0 then 'Revenue' when n_nationkey % 6 = 1 then 'COGS'
            when n_nationkey % 6 = 2 then ' OPEX' when n_nationkey % 6 = 3 then 'Depreciation'
            when n_nationkey % 6 = 4 then 'Financial' else 'tax' end as pl_group,
        cast(case when n_nationkey < 15 and n_nationkey % 6 = 0 then 1
            when n_nationkey >= 15 and n_nationkey % 5 in (0, 1) then 1
            when n_nationkey = 24 then null else -1 end as int) as pl_sign,
        cast(n_nationkey % 2 as int) as is_monetary,
        case when n_nationkey < 15 and n_nationkey % 6 = 0 then 'Credit' when n_nationkey < 15 then 'Debit'
            when n_nationkey % 5 in (0, 1) then ' Debit' else 'CREDIT' end as normal_balance,
        {_versioned("1C", "account", "n_nationkey")}
    from (select *, {{versions_n_nationkey}} as v from {{nation}}) as n""",
    "stg_purchase_orders": f"""
    select o_orderkey as po_id, concat('PO', cast(o_orderkey as string), ' ') as po_code,
        o_orderkey % 100 as supplier_id, o_orderkey % 25 + 1 as warehouse_id, cast(o_orderdate as date) as po_date,
        cast(o_orderdate as date) + 14 as expected_delivery,
        case when o_orderstatus = 'O' then ' '
            else cast(cast(o_orderdate as date) + cast(10 + o_orderkey % 14 as int) as string) end as actual_delivery,
        case when o_orderstatus = 'F' then ' Delivered' when o_orderstatus = 'P' then 'Partial'
            when o_orderpriority = '5-LOW' then 'Cancelled' else 'pending ' end as status,
        'RUB ' as currency_code, {_ORDER_TOTAL} as total_amount, {_ORDER_LOAD}
    from {{orders}}""",
    "stg_purchase_order_lines": f"""
    select {_LINE_KEY} as po_line_id, l_orderkey as po_id, l_partkey as product_id,
        concat(' SKU', cast(l_partkey as string)) as sku_code, concat('CAT', cast(l_partkey % 5 as string)) as category,
        cast(l_quantity as bigint) as quantity, {_UNIT_PRICE} as unit_price, {_PRICE} as line_amount,
        cast(case when l_returnflag = 'R' then 0 when l_returnflag = 'A' then l_quantity
            when l_linenumber = 7 then l_quantity + 1 else floor(l_quantity / 2) end as bigint) as received_qty,
        {_LINE_LOAD}
    from {{lineitem}}""",
    "stg_sales_orders": f"""
    select o_orderkey as order_id, concat(' SO', cast(o_orderkey as string)) as order_code, o_custkey as client_id,
        o_custkey % 11 as manager_id, o_orderkey % 25 + 1 as warehouse_id, cast(o_orderdate as date) as order_date,
        cast(o_orderdate as date) + cast(o_orderkey % 10 as int) as shipment_date,
        case when o_orderstatus = 'F' then 'Completed' when o_orderstatus = 'P' then 'partial ' else 'Cancelled' end
            as status,
        case when o_orderstatus = 'F' then ' Paid' when o_orderstatus = 'P' then 'Partial' else 'unpaid' end
            as payment_status,
        'RUB' as currency_code, cast(cast(o_orderkey % 11 as decimal(5,0)) * {_HUNDREDTH} as decimal(18,4)) as discount_pct,
        {_ORDER_TOTAL} as total_amount, {_ORDER_LOAD}
    from {{orders}}""",
    "stg_sales_order_lines": f"""
    select {_LINE_KEY} as order_line_id, l_orderkey as order_id, l_partkey as product_id,
        concat('SKU', cast(l_partkey as string), ' ') as sku_code,
        concat('CAT', cast(l_partkey % 5 as string)) as category,
        concat('Brand#', cast(l_partkey % 25 as string)) as brand, cast(l_quantity as bigint) as quantity,
        case when l_quantity = 7 and l_tax = 0 then cast(0 as decimal(18,2)) else {_UNIT_PRICE} end as unit_price,
        cast({_UNIT_PRICE} * ({_COST_RATE}) as decimal(18,2)) as unit_cost, {_REVENUE} as line_revenue,
        {_LINE_COGS} as line_cogs, cast({_REVENUE} - {_LINE_COGS} as decimal(18,2)) as line_gross_profit, {_LINE_LOAD}
    from {{lineitem}}""",
    "stg_invoices": f"""
    select o_orderkey * 2 as invoice_id, concat('AR-', lpad(cast(o_orderkey as string), 10, '0'), ' ') as invoice_code,
        ' AR' as invoice_type,
        case when o_orderkey % 50 = 0 then o_custkey + 1000000000000 else o_custkey end as counterparty_id,
        'Client' as counterparty_type, o_orderkey as order_id, cast(o_orderdate as date) as invoice_date,
        cast(o_orderdate as date) + 30 as due_date, 'RUB' as currency_code, {_ORDER_TOTAL} as amount,
        case when o_orderstatus = 'F' then {_ORDER_TOTAL} when o_orderstatus = 'P' then {_HALF_TOTAL}
            else cast(0 as decimal(18,2)) end as paid_amount,
        case when o_orderstatus = 'F' then cast(0 as decimal(18,2))
            when o_orderstatus = 'P' then cast({_ORDER_TOTAL} - {_HALF_TOTAL} as decimal(18,2))
            else {_ORDER_TOTAL} end as outstanding,
        cast(case when o_orderstatus = 'F' then 0 else o_orderkey % 150 - 20 end as int) as days_overdue,
        case when o_orderstatus = 'F' then 'Paid' when o_orderstatus = 'P' then ' partial' else 'Unpaid' end as status,
        {_ORDER_LOAD}
    from {{orders}}
    union all
    select ({_LINE_KEY}) * 2 + 1 as invoice_id,
        concat('AP-', lpad(cast({_LINE_KEY} as string), 12, '0')) as invoice_code, 'AP ' as invoice_type,
        l_suppkey as counterparty_id, ' Supplier' as counterparty_type, l_orderkey as order_id,
        cast(l_shipdate as date) as invoice_date, cast(l_shipdate as date) + 30 as due_date, 'RUB' as currency_code,
        {_PRICE} as amount,
        case when l_linestatus = 'F' then {_PRICE} when l_returnflag = 'N' then {_HALF_PRICE}
            else cast(0 as decimal(18,2)) end as paid_amount,
        case when l_linestatus = 'F' then cast(0 as decimal(18,2))
            when l_returnflag = 'N' then cast({_PRICE} - {_HALF_PRICE} as decimal(18,2)) else {_PRICE} end as outstanding,
        cast(case when l_linestatus = 'F' then 0 else l_partkey % 150 - 20 end as int) as days_overdue,
        case when l_linestatus = 'F' then 'paid' else 'Unpaid' end as status, {_LINE_LOAD}
    from {{lineitem}}""",
    "stg_inventory_movements": f"""
    select {_LINE_KEY} as move_id,
        case when l_returnflag = 'R' then ' Receipt' when l_returnflag = 'A' then 'Shipment'
            when l_linenumber = 7 then 'WriteOff' else 'adjustment ' end as move_type,
        'Order' as reference_type, l_orderkey as reference_id, l_partkey as product_id,
        l_suppkey % 25 + 1 as warehouse_id,
        cast(case when l_returnflag = 'R' then l_quantity else -l_quantity end as int) as quantity,
        case when l_tax = 0.08 then cast(0 as decimal(18,2)) else {_UNIT_PRICE} end as unit_cost,
        cast(l_shipdate as date) as move_date, {_LINE_LOAD}
    from {{lineitem}}""",
    "stg_gl_postings": f"""
    select ({_LINE_KEY}) * 2 as gl_id, cast(l_shipdate as date) as posting_date, ' Shipment' as doc_type,
        cast(case when l_quantity = 2 then 99 when l_returnflag = 'A' and l_linestatus = 'F' then 1
            when l_returnflag = 'A' then 2 when l_returnflag = 'N' and l_linestatus = 'F' then 3
            when l_returnflag = 'N' then 4 when l_linestatus = 'F' then 5 else 6 end
            + 6 * (l_linenumber % 2) as bigint) as account_id,
        cast(16 + l_linenumber % 10 as bigint) as contra_account_id, {_PRICE} as amount_base, 'RUB ' as currency_code,
        concat('Line ', cast(l_linenumber as string), ' ') as description,
        cast(l_orderkey % 3 + 1 as int) as scenario_id, {_LINE_LOAD}
    from {{lineitem}}
    union all
    select o_orderkey * 2 + 1 as gl_id, cast(o_orderdate as date) as posting_date, 'Order ' as doc_type,
        cast(15 + cast(substring(o_orderpriority, 1, 1) as int) + 5 * (o_orderkey % 2) as bigint) as account_id,
        cast(1 + o_orderkey % 15 as bigint) as contra_account_id, {_ORDER_TOTAL} as amount_base,
        'RUB' as currency_code, concat(' Order ', o_orderpriority) as description,
        cast(o_orderkey % 3 + 1 as int) as scenario_id, {_ORDER_LOAD}
    from {{orders}}""",
    "stg_marketing_spend": f"""
    select event_id as spend_id, concat(cast(user_id % 20 as string), '') as campaign_id,
        concat(' Campaign ', cast(user_id % 20 as string)) as campaign_name,
        concat('Platform ', cast(user_id % 4 as string), ' ') as platform,
        make_date(cast(1997 + event_id % 4 as int), cast(1 + floor(event_id / 4) % 12 as int),
            cast(least(day(cast(ts as date)), 28) as int)) as spend_date,
        cast(case when event_type = 'error' then 0 else 100 + event_id % 900 end as bigint) as impressions,
        cast(case when event_type in ('view', 'error') then 0 else event_id % 100 end as bigint) as clicks,
        cast(case when event_type = 'purchase' then event_id % 10 else 0 end as bigint) as conversions,
        cast(case when event_id % 40 = 0 then 0 else value end as decimal(18,2)) as spend_amount,
        'RUB' as currency_code,
        {_load("CRM", "md5(cast(event_id as string))", "'batch_0001'", "cast(ts as date)",
               "case when event_id % 101 = 0 then 1 else 0 end")}
    from {{events}}""",
    "dim_city": "select n_nationkey as city_id, n_name as city_name from {nation}",
    "dim_counterparty": """
    select s_suppkey as cp_id, s_name as cp_name, concat('N', cast(s_nationkey as string)) as cp_type from {supplier}""",
    "dim_expense_category": """
    select cast(n_nationkey as bigint) as cat_id, r_name as group_name,
        concat(r_name, ' ', cast(n_nationkey % 3 as string)) as group_stat, n_name as stat_name
    from {nation} as n join {region} as r on r_regionkey = n_regionkey where n_nationkey > 0""",
    "fact_pnl": f"""
    select make_date(cast(year(l_shipdate) as int), cast(month(l_shipdate) as int), 1) as month,
        cast(l_suppkey % 25 as int) as city_id, l_partkey % 25 as cat_id, l_extendedprice as revenue,
        cast({_LINE_COGS} as double) as cogs, cast({_PRICE} - {_LINE_COGS} as double) as gross_profit,
        cast({_OPERATING_COST} as double) as operating_cost,
        cast({_PRICE} - {_LINE_COGS} - {_OPERATING_COST} as double) as ebitda,
        cast({_PRICE} - {_LINE_COGS} - {_OPERATING_COST} - {_HALF_PRICE} as double) as net_profit,
        cast({_HALF_PRICE} as double) as tax
    from {{lineitem}}""",
    "fact_payments": """
    select cast(o_orderdate as date) as dt, cast(o_custkey % 25 as int) as city_id, o_custkey % 100 as cp_id,
        o_orderkey % 25 as cat_id, o_orderkey as doc_number, o_totalprice as planned_sales,
        cast(floor(o_totalprice / 3) as double) as amount_to_pay,
        cast(cast(o_totalprice as decimal(18,2)) - cast(floor(o_totalprice / 3) as decimal(18,0)) as double) as balance,
        cast(case when o_orderstatus = 'F' then 1 else 0 end as int) as is_paid,
        cast(o_orderdate as date) + cast(o_orderkey % 30 as int) as due_date
    from {orders}""",
    "fact_expenses": """
    select cast(o_orderdate as date) as dt, cast(o_custkey % 25 as int) as city_id, o_custkey % 100 as cp_id,
        o_orderkey % 25 as cat_id, o_orderkey as doc_number, cast(o_orderkey % 2 as int) as mc_flag,
        o_orderpriority as item_name,
        case when o_orderkey % 17 = 0 then cast(0 as double) else o_totalprice end as amount,
        cast(case when o_orderkey % 25 = 0 then 0 else 1 end as int) as has_category
    from {orders}""",
}

VERSION_KEYS = ["n_nationkey", "s_suppkey", "c_custkey", "p_partkey"]


def statement(table: str, tables: dict[str, str], versions: str = SPARK_VERSIONS) -> str:
    """The mapping of one table with its inputs and the version generator filled in."""
    generators = {f"versions_{key}": versions.format(key=key) for key in VERSION_KEYS}
    return STATEMENTS[table].format(**generators, **tables)


def tpch_source(spark: SparkSession, folder: str) -> Source:
    """Source tables over the parquet files of ``folder``."""

    @cache
    def base(name: str) -> DataFrame:
        return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))

    def read(table: str) -> DataFrame:
        inputs = {name: base(name) for name in BASE_TABLES if f"{{{name}}}" in STATEMENTS[table]}
        text = statement(table, {name: f"{{{name}}}" for name in BASE_TABLES})
        return spark.sql(text, **inputs).select(*schema_of(table).fieldNames())

    return read
