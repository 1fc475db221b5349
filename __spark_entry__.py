
from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable
from functools import reduce

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)
#: Python workers of a session started after this import find the package too.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [HERE, os.environ.get("PYTHONPATH")]))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

import oracle  # noqa: E402
from finmarts.functions import calendar as cal  # noqa: E402
from finmarts.functions.calendar import CalendarRange  # noqa: E402
from finmarts.functions.numeric import TOTAL, money, percent, safe_ratio, sum_if, sum_total  # noqa: E402
from finmarts.operators.changes import previous_month, year_to_date  # noqa: E402
from finmarts.operators.latest import latest, latest_live, replace_by_key, sum_merge  # noqa: E402
from finmarts.operators.periods import explode_periods  # noqa: E402
from finmarts.operators.upsert import LOOKBACK_DAYS, merge_rows  # noqa: E402
from finmarts.plans import pnl  # noqa: E402
from finmarts.plans.expectations import EXPECTATIONS  # noqa: E402
from finmarts.plans.reports import Reports  # noqa: E402
from finmarts.plans.warehouse import DIMS, FACTS, MARTS, MONTHLY, ODS, Warehouse  # noqa: E402
from finmarts.sources import versions  # noqa: E402
from finmarts.sources.readers import Source  # noqa: E402
from finmarts.sources.tpch import tpch_source  # noqa: E402
from finmarts.sources.workdir import fresh_folder  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from finmarts.llm import queries as llm  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "finmarts.llm"):
        raise
    TEXT_QUERIES, TEXT_SQL = {}, {}
else:
    TEXT_QUERIES = {**llm.QUERIES, "pipeline": corpus_pipeline.run}
    TEXT_SQL = {**llm.ORACLE_SQL, "pipeline": corpus_pipeline.ORACLE_SQL}

AS_OF = dt.date(2001, 8, 1)
CALENDAR = CalendarRange(dt.date(1995, 1, 1), dt.date(2001, 12, 31))
SMOKE_DATA = "/root/testdata/sf0.001"
Query = Callable[[SparkSession, str], DataFrame]

#: Tables without rows of their own from the data (fixed lists) are covered by unit tests instead.
FIXED_LISTS = {"dim_channel", "dim_scenario", "dim_date"}
REGISTERS = [
    "stg_pnl", "stg_payments", "stg_expenses", "mart_pnl_monthly", "mart_payment_calendar", "mart_unpaid",
    "mart_expenses_detail", "mart_expenses_no_category",
]


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, tpch_source(spark, sf_dir), AS_OF, CALENDAR)


def _base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))


def _warehouse_table(name: str) -> Query:
    return lambda spark, sf_dir: warehouse(spark, sf_dir).table(name)


def _register_table(name: str) -> Query:
    return lambda spark, sf_dir: Reports(tpch_source(spark, sf_dir)).table(name)


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = _base(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    return cal.select_date_attributes(cal.days_between_first_and_last(shipped, "day"))


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _base(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    order = [
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    ]
    return latest(lines, ["l_orderkey", "l_linenumber"], order)


def dedup_tombstone_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients = tpch_source(spark, sf_dir)("stg_clients")
    return latest_live(clients, ["client_id"], tombstone_wins=True).select(
        "client_id", F.trim("client_name").alias("client_name"), "_batch_id"
    )


def replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _base(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        money("o_totalprice").alias("amount"),
        F.col("o_orderdate").cast("date").alias("version"),
    )
    shipped = _base(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        money("l_extendedprice").alias("amount"),
        F.col("l_shipdate").cast("date").alias("version"),
    )
    return replace_by_key(orders, shipped, ["order_id"], "version")


def summed(spark: SparkSession, sf_dir: str) -> DataFrame:
    def part(table: str, date: str, key: str, amount: str) -> DataFrame:
        return (
            _base(spark, sf_dir, table)
            .groupBy(
                cal.month_start(F.col(date).cast("date")).alias("month"),
                (F.col(key) % 3 + 1).cast("int").alias("scenario_id"),
            )
            .agg(sum_total(money(amount)).alias("amount"), F.count(F.lit(1)).alias("postings"))
        )

    parts = [
        part("lineitem", "l_shipdate", "l_orderkey", "l_extendedprice"),
        part("orders", "o_orderdate", "o_orderkey", "o_totalprice"),
    ]
    return sum_merge(parts, ["month", "scenario_id"], ["amount", "postings"])


def tenure_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    managers = warehouse(spark, sf_dir).dim_manager
    return managers.groupBy("tenure_group").agg(F.count(F.lit(1)).alias("managers"))


DQ_FLAGS = {
    "ods_accounts": ["dq_valid_stmt_type"],
    "ods_clients": ["dq_has_manager"],
    "ods_gl_postings": ["dq_missing_account"],
    "ods_inventory_movements": ["dq_zero_cost"],
    "ods_marketing_spend": ["dq_zero_spend"],
    "ods_purchase_orders": ["dq_has_delivery"],
    "ods_purchase_order_lines": ["dq_qty_mismatch"],
    "ods_sales_order_lines": ["dq_negative_margin", "dq_zero_price"],
    "ods_sales_orders": ["dq_valid_amount"],
}


def dq_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = warehouse(spark, sf_dir)
    counted = []
    for name, flags in DQ_FLAGS.items():
        totals = tables.table(name).agg(F.count(F.lit(1)).alias("n"), *[F.sum(f).alias(f) for f in flags])
        rows = [
            F.struct(
                F.lit(name).alias("table_name"), F.lit(f).alias("flag"), F.col(f).alias("flagged_rows"),
                F.col("n").alias("all_rows"),
            )
            for f in flags
        ]
        counted.append(totals.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, counted)


def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger built up to the end of June, then refreshed from a source with other amounts and moved postings."""
    columns = ["gl_id", "posting_date", "account_id", "amount_base"]
    ledger = warehouse(spark, sf_dir).fct_gl_entry.select(*columns)
    built = ledger.where(F.col("posting_date") <= F.lit(dt.date(2001, 6, 30)))
    later = ledger.withColumns({
        "posting_date": F.when(F.col("gl_id") % 11 == 0, F.add_months("posting_date", 1)).otherwise(F.col("posting_date")),
        "amount_base": F.when(F.col("gl_id") % 7 == 0, F.col("amount_base") * 2).otherwise(F.col("amount_base")).cast("decimal(18,2)"),
    })
    newest = built.agg(F.max("posting_date")).scalar()
    recent = (F.col("posting_date") >= F.date_sub(newest, LOOKBACK_DAYS)) | F.col("posting_date").isNull()
    batch = later.where(recent).withColumn("loaded_by", F.lit("increment"))
    return merge_rows(built.withColumn("loaded_by", F.lit("full build")), batch, ["gl_id"])


#: Staging table -> (date by which its rows arrive, last such day of the earlier state).
ARRIVES_BY = {
    "stg_gl_postings": ("posting_date", dt.date(2001, 5, 20)),
    "stg_sales_orders": ("order_date", dt.date(2001, 5, 20)),
    "stg_marketing_spend": ("spend_date", dt.date(1997, 1, 20)),
    "stg_clients": ("_ingested_at", dt.date(2001, 7, 1)),
    "stg_products": ("_ingested_at", dt.date(2001, 7, 1)),
}
LEDGER = ["ods_accounts", "ods_gl_postings", "fct_gl_entry"]
SALES = [
    "ods_clients", "ods_products", "dim_client", "dim_product", "ods_sales_orders", "ods_sales_order_lines",
    "fct_sales_order_line",
]


def earlier(source: Source) -> Source:
    """What a source held in an earlier state."""

    def read(table: str) -> DataFrame:
        rows = source(table)
        if table not in ARRIVES_BY:
            return rows
        date, last = ARRIVES_BY[table]
        return rows.where(F.col(date) <= F.lit(last))

    return read


def published_twice(spark: SparkSession, sf_dir: str, path: str, tables: list[str]) -> None:
    """Publish what was there earlier, then refresh it with everything."""
    source = tpch_source(spark, sf_dir)
    Warehouse(spark, earlier(source), AS_OF, CALENDAR).publish(path, tables)
    Warehouse(spark, source, AS_OF, CALENDAR).publish(path, tables)


#: Query -> (table that is read back after a refresh, the tables published for it).
REFRESHED = {
    "refreshed_pnl": ("dm_pnl_periodic", [*LEDGER, "dm_pnl_periodic"]),
    "refreshed_balances": ("int_balance_monthly", [*LEDGER, "int_balance_monthly"]),
    "refreshed_clients": ("dim_client", ["ods_clients", "dim_client"]),
    "refreshed_order_lines": ("fct_sales_order_line", SALES),
    "refreshed_sales": ("int_sales_monthly", [*SALES, "int_sales_monthly"]),
    "refreshed_sales_marketing": (
        "dm_sales_marketing_periodic", [*SALES, "ods_marketing_spend", "fct_marketing_spend", "dm_sales_marketing_periodic"],
    ),
}


def _refreshed(name: str) -> Query:
    table, published = REFRESHED[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = fresh_folder(spark, name)
        published_twice(spark, sf_dir, path, published)
        return versions.read(spark, f"{path}/{table}").select(*warehouse(spark, sf_dir).table(table).columns)

    return run


def pivot_sum_if(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pnl.daily_lines(warehouse(spark, sf_dir).fct_gl_entry)


def count_distinct_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct counts of three columns, each from one row a value, so that no line is repeated."""
    lines = warehouse(spark, sf_dir).fct_sales_order_line
    group = ["client_segment", "product_category"]

    def once(*columns: str) -> DataFrame:
        return lines.groupBy(*group, *columns).agg(F.count(F.lit(1)).alias("lines"))

    orders = once("client_id", "order_id")
    # an order has one client, but lines without an order have neither
    per_client = orders.groupBy(*group, "client_id").agg(F.count("order_id").alias("orders"))
    counted = per_client.groupBy(*group).agg(F.sum("orders").alias("orders"), F.count("client_id").alias("clients"))
    products = once("product_id").groupBy(*group).agg(F.count("product_id").alias("products"))
    renamed = products.select(*[F.col(c).alias(f"_{c}") for c in group], "products")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group]
    return counted.join(renamed, same).select(*group, "orders", "clients", "products")


def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _base(spark, sf_dir, "lineitem").withColumn("price", money("l_extendedprice"))
    returned = F.col("l_returnflag") == "R"
    taxed = (F.col("l_returnflag") == "A") & (F.col("l_tax") == 0.08)
    sums = lines.groupBy(F.col("l_suppkey").alias("supplier_id")).agg(
        sum_if("price", returned).alias("returned"), sum_if("price", taxed).alias("taxed")
    )
    return sums.select("supplier_id", safe_ratio("returned", "taxed").alias("returned_to_taxed"))


def rolling_45d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings per rolling 45 days ending at each month end that has postings."""
    ledger = warehouse(spark, sf_dir).fct_gl_entry
    daily = ledger.groupBy("posting_date", "scenario_id").agg(
        sum_total("amount_base").alias("amount"), F.count(F.lit(1)).alias("postings")
    )
    windows = (
        explode_periods(daily, "posting_date", ["rolling_45d"])
        .groupBy("period_type", "period_start", "period_end", "scenario_id")
        .agg(
            sum_total("amount").alias("amount"),
            F.sum("postings").alias("postings"),
            F.max("_own_end").alias("_own_end"),
        )
    )
    return pnl.rolling_with_data(windows).drop("period_type")


def ytd_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = warehouse(spark, sf_dir).int_pnl_monthly
    running = year_to_date("total_signed", ["account_id", "scenario_id", "year"], "period")
    return months.select(
        "period", "year", "account_id", "scenario_id", "total_signed", running.alias("total_signed_ytd")
    )


def balance_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    balances = warehouse(spark, sf_dir).int_balance_monthly
    both = previous_month(
        balances, ["account_id", "scenario_id"], "period", {"previous_balance": "ending_balance"}, month_ends=True
    )
    delta = (F.col("ending_balance") - F.col("previous_balance")).cast(TOTAL)
    return both.select(
        "period", "account_id", "scenario_id", "ending_balance", "previous_balance", delta.alias("delta")
    )


def mom_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = pnl.monthly(warehouse(spark, sf_dir).int_pnl_monthly).select("period_start", "scenario_id", "revenue")
    both = previous_month(months, ["scenario_id"], "period_start", {"prev_revenue": "revenue"})
    change = percent(F.col("revenue") - F.col("prev_revenue"), "prev_revenue")
    return both.withColumn("revenue_mom_pct", change)


def _checks(prefix: str) -> Query:
    names = [t for t in EXPECTATIONS if t.startswith(prefix) and t not in FIXED_LISTS]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = warehouse(spark, sf_dir)
        return reduce(DataFrame.unionByName, [tables.checks(name) for name in names])

    return run


def data_checks_registers(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = Reports(tpch_source(spark, sf_dir))
    names = ["stg_pnl", "stg_payments", "stg_expenses", "mart_pnl_monthly"]
    return reduce(DataFrame.unionByName, [reports.checks(name) for name in names])


OPERATOR_QUERIES: dict[str, Query] = {
    "dim_date": dim_date,
    "dedup_latest": dedup_latest,
    "dedup_tombstone_wins": dedup_tombstone_wins,
    "replace_by_key": replaced,
    "sum_merge": summed,
    "tenure_groups": tenure_groups,
    "dq_flags": dq_flags,
    "incremental_upsert": incremental_upsert,
    "pivot_sum_if": pivot_sum_if,
    "count_distinct_multi": count_distinct_multi,
    "safe_ratio": ratios,
    "rolling_45d": rolling_45d,
    "ytd_running_sum": ytd_running_sum,
    "balance_delta": balance_delta,
    "mom_change": mom_change,
    "data_checks_ods": _checks("ods_"),
    "data_checks_dims": _checks("dim_"),
    "data_checks_facts": _checks("fct_"),
    "data_checks_marts": _checks("dm_"),
    "data_checks_registers": data_checks_registers,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the P&L report at all four grains."""
    return warehouse(spark, SMOKE_DATA).dm_pnl_periodic


def queries() -> dict[str, Query]:
    """Every table of both lineages and the single operators behind them."""
    tables = [t for t in [*ODS, *DIMS, *FACTS, *MONTHLY, *MARTS] if t not in FIXED_LISTS]
    return {
        **{name: _warehouse_table(name) for name in tables},
        **{name: _register_table(name) for name in REGISTERS},
        **OPERATOR_QUERIES,
        **{name: _refreshed(name) for name in REFRESHED},
        **TEXT_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    tables = {name: table for name, (table, _) in REFRESHED.items()}  # a refresh gives what a full build gives
    expected = {name: oracle.expected(tables.get(name, name)) for name in queries() if name not in TEXT_QUERIES}
    return {**expected, **{name: sql for name, sql in TEXT_SQL.items() if sql}}
