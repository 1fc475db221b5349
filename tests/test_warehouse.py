"""Publishing both lineages, incremental refresh, and typed CSV sources."""

import os

import pytest
from helpers import DATA, day, rows

import __spark_entry__ as entry
from finmarts.plans.reports import Reports
from finmarts.plans.warehouse import Warehouse
from finmarts.sources.readers import csv_source, parquet_source
from finmarts.sources.schemas import STAGING
from finmarts.sources import versions
from finmarts.sources.tpch import STATEMENTS, tpch_source

SEED_FILES = {
    "dim_city": ["city_id,city_name", "1,North", "2,South"],
    "dim_counterparty": ["cp_id,cp_name,cp_type", "1,Acme,LLC", "2,Bolt,LLC"],
    "dim_expense_category": ["cat_id,group_name,group_stat,stat_name", "1,G,S,Rent", "2,G,S,Ads"],
    "fact_pnl": [
        "month,city_id,cat_id,revenue,cogs,gross_profit,operating_cost,ebitda,net_profit,tax",
        "2024-01-01,1,1,100.5,40,60.5,20,40.5,30,10.5", "2024-01-01,1,2,99.5,60,39.5,20,19.5,10,9.5",
        "2024-01-01,2,1,0,0,0,0,0,5,0", "2024-01-01,0,1,7,7,7,7,7,7,7", ",1,1,7,7,7,7,7,7,7",
    ],
    "fact_payments": [
        "dt,city_id,cp_id,cat_id,doc_number,planned_sales,amount_to_pay,balance,is_paid,due_date",
        "2024-11-17,1,1,1,1,300,200,750,1,2024-11-17", "2024-11-18,1,1,1,2,10,4,6,0,2024-11-20",
        "2024-11-18,1,1,1,3,10,5,5,0,2024-11-20", "2024-11-19,1,2,9,4,10,5,5,0,2024-11-20",
    ],
    "fact_expenses": [
        "dt,city_id,cp_id,cat_id,doc_number,mc_flag,item_name,amount,has_category",
        "2024-08-01,1,1,1,10,1,Rent,100,1", "2024-08-02,2,2,0,11,0,Other,50.25,0", "2024-08-03,1,1,1,12,1,Free,0,1",
        "2024-08-04,9,1,1,13,1,Lost city,5,1",
    ],
}


@pytest.fixture
def seeds(spark, tmp_path):
    for name, lines in SEED_FILES.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return csv_source(spark, str(tmp_path)), tmp_path


def test_registers_from_csv(seeds):
    reports = Reports(seeds[0])
    assert [(r.city_name, float(r.revenue), r.net_margin_pct, r.ebitda_margin_pct) for r in reports.mart_pnl_monthly.orderBy("city_name").collect()] == [
        ("North", 200.0, 20.0, 30.0), ("South", 0.0, None, None),
    ]
    assert [(r.dt, float(r.balance)) for r in reports.mart_payment_calendar.orderBy("dt").collect()] == [
        (day("2024-11-17"), 750.0), (day("2024-11-18"), 11.0), (day("2024-11-19"), 5.0),
    ]
    assert [(r.due_date, r.cp_name, r.expense_stat, float(r.total_amount)) for r in reports.mart_unpaid.collect()] == [
        (day("2024-11-20"), "Acme", "Rent", 9.0)
    ]
    assert rows(reports.mart_expenses_detail, "doc_number", "city_name", "stat_name", "month") == [
        (10, "North", "Rent", day("2024-08-01")), (11, "South", None, day("2024-08-01")),
    ]
    assert rows(reports.mart_expenses_no_category, "doc_number", "cp_name") == [(11, "Bolt")]


def test_malformed_value_fails_the_load(seeds, spark):
    source, folder = seeds
    (folder / "dim_city.csv").write_text("city_id,city_name\nx,North\n", encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED"):
        source("dim_city").collect()


def test_mapping_has_the_declared_types(spark):
    from finmarts.sources.schemas import schema_of

    source = tpch_source(spark, DATA)
    for table in STATEMENTS:
        assert source(table).dtypes == [(f.name, f.dataType.simpleString()) for f in schema_of(table).fields], table


FACTS_PUBLISHED = ["fct_gl_entry", "fct_sales_order_line"]
COMPARED = [*FACTS_PUBLISHED, "dim_product", "int_balance_monthly", "dm_exec_kpi_monthly"]
PUBLISHED = [
    *COMPARED, "ods_accounts", "ods_clients", "ods_products", "ods_sales_orders", "ods_sales_order_lines",
    "ods_gl_postings", "dim_client",
]


def test_publish_then_refresh(spark, tmp_path):
    """A published warehouse equals the lazy one, and a second run leaves it the same."""
    staging = str(tmp_path / "staging")
    mapped = tpch_source(spark, DATA)
    for table in [t for t in STAGING if t.replace("stg_", "ods_") in PUBLISHED]:
        mapped(table).write.parquet(os.path.join(staging, table))
    target = str(tmp_path / "warehouse")

    def built() -> Warehouse:
        return Warehouse(spark, parquet_source(spark, staging), entry.AS_OF, entry.CALENDAR)

    built().publish(target, tables=PUBLISHED)
    lazy = entry.warehouse(spark, DATA)
    first = {}
    for name in COMPARED:
        columns = lazy.table(name).columns
        first[name] = rows(versions.read(spark, os.path.join(target, name)), *columns)
        assert first[name] == rows(lazy.table(name)), name
    built().publish(target, tables=FACTS_PUBLISHED)
    for name in FACTS_PUBLISHED:
        assert rows(versions.read(spark, os.path.join(target, name)), *lazy.table(name).columns) == first[name], name
    assert len(versions.manifest(spark, os.path.join(target, "fct_gl_entry")).folders) > 60


def test_fixed_lists(spark):
    channels = entry.warehouse(spark, DATA).dim_channel
    assert rows(channels, "channel_id", "is_digital") == [(1, 0), (2, 1), (3, 1), (4, 0), (5, 0), (6, 0)]
    assert rows(entry.warehouse(spark, DATA).dim_scenario, "scenario_id", "is_actual") == [(1, 1), (2, 0), (3, 0), (4, 0)]
