"""Refreshed tables equal a full build, and a refresh touches what has changed only."""

import os

import pytest
from helpers import DATA, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from finmarts.operators.keyed import merge_arrivals, unseen
from finmarts.plans import refresh
from finmarts.plans.warehouse import Warehouse
from finmarts.sources import versions
from finmarts.sources.tpch import tpch_source

LEDGER = [*entry.LEDGER, "int_pnl_monthly", "int_balance_monthly", "dm_pnl_periodic"]
SALES = [*entry.SALES, "ods_marketing_spend", "fct_marketing_spend", "int_sales_monthly", "dm_sales_marketing_periodic"]


@pytest.fixture(scope="module", params=[LEDGER, SALES], ids=["ledger", "sales"])
def refreshed(request, spark, tmp_path_factory):
    """A warehouse published as of an earlier day and then with everything: its path, tables, and states of both."""
    path = str(tmp_path_factory.mktemp("refreshed"))
    source = tpch_source(spark, DATA)
    names = [*request.param, *(f"stores/{s}" for s in ("stg_clients", "stg_products", "stg_accounts"))]

    def states():
        return {n: s for n in names if (s := versions.manifest(spark, os.path.join(path, n)))}

    Warehouse(spark, entry.earlier(source), entry.AS_OF, entry.CALENDAR).publish(path, request.param)
    first = states()
    Warehouse(spark, source, entry.AS_OF, entry.CALENDAR).publish(path, request.param)
    return path, request.param, first, states()


def test_equals_a_full_build(spark, refreshed):
    path, tables, _, _ = refreshed
    lazy = entry.warehouse(spark, DATA)
    for name in tables:
        columns = lazy.table(name).columns
        assert rows(versions.read(spark, os.path.join(path, name)), *columns) == rows(lazy.table(name)), name


def test_years_that_did_not_change_keep_their_files(spark, tmp_path):
    """Postings of the last day come in: the ledger's last month and the last years of the reports are replaced."""
    path, source = str(tmp_path), tpch_source(spark, DATA)
    last = source("stg_gl_postings").agg(entry.F.max("posting_date")).first()[0]

    def more(table):
        rows_ = source(table)
        if table != "stg_gl_postings":
            return rows_
        new = rows_.where(entry.F.col("posting_date") == entry.F.lit(last))
        return rows_.unionByName(new.withColumn("gl_id", (entry.F.col("gl_id") + 10**9).cast(rows_.schema["gl_id"].dataType)))

    Warehouse(spark, source, entry.AS_OF, entry.CALENDAR).publish(path, LEDGER)
    first = {n: versions.manifest(spark, f"{path}/{n}") for n in LEDGER}
    marts = Warehouse(spark, more, entry.AS_OF, entry.CALENDAR)
    marts.publish(path, LEDGER)
    then = {n: versions.manifest(spark, f"{path}/{n}") for n in LEDGER}
    month, year = last.year * 100 + last.month, last.year
    assert versions.changed(first["fct_gl_entry"].folders, then["fct_gl_entry"].folders) == [month]
    for name in LEDGER[3:]:
        replaced = versions.changed(first[name].folders, then[name].folders)
        assert set(replaced) <= {year - 1, year} and year in replaced and len(then[name].folders) > 3
        lazy = Warehouse(spark, more, entry.AS_OF, entry.CALENDAR).table(name)
        assert rows(versions.read(spark, f"{path}/{name}"), *lazy.columns) == rows(lazy), name


def test_nothing_new_rewrites_no_aggregate(spark, refreshed):
    path, tables, _, then = refreshed
    upper = [n for n in tables if n.startswith(("int_", "dm_"))]
    Warehouse(spark, tpch_source(spark, DATA), entry.AS_OF, entry.CALENDAR).publish(path, upper)
    for name in upper:
        assert versions.manifest(spark, os.path.join(path, name)).number == then[name].number


def test_lines_of_a_refresh_are_pruned_by_month(spark, refreshed):
    path, tables, _, _ = refreshed
    if "fct_sales_order_line" not in tables:
        pytest.skip("no lines here")
    marts = Warehouse(spark, tpch_source(spark, DATA), entry.AS_OF, entry.CALENDAR)
    marts.publish(path, ["dim_client"])
    target = os.path.join(path, "fct_sales_order_line")
    batch = marts._recent("fct_sales_order_line", target, versions.manifest(spark, target), "order_date")
    plan = batch._jdf.queryExecution().sparkPlan().toString().split("FileScan")[1:]
    scans = [scan for scan in plan if "order_line_id" in scan.split("]")[0]]
    assert scans and all("ym" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)
    whole = versions.read(spark, os.path.join(path, "ods_sales_order_lines"))
    assert 0 < batch.count() < whole.count() / 10


def test_headers_of_another_state_prune_no_lines(spark, tmp_path):
    path = str(tmp_path)
    source = tpch_source(spark, DATA)
    tables = ["ods_sales_orders", "ods_sales_order_lines", "ods_clients", "ods_products", "dim_client", "dim_product", "fct_sales_order_line"]
    Warehouse(spark, entry.earlier(source), entry.AS_OF, entry.CALENDAR).publish(path, tables)
    # orders come without their lines being laid out anew
    Warehouse(spark, source, entry.AS_OF, entry.CALENDAR).publish(path, ["ods_sales_orders", "fct_sales_order_line"])
    lazy = entry.warehouse(spark, DATA)
    columns = lazy.fct_sales_order_line.columns
    assert rows(versions.read(spark, f"{path}/fct_sales_order_line"), *columns) == rows(lazy.fct_sales_order_line)


VERSIONED = "id long, name string, _ingested_at date, _batch_id string, _row_hash string, _is_deleted int"


def arrivals(spark, *data):
    made = [(i, n, d, "b", f"{n}{d}", x) for i, n, d, x in data]
    text = VERSIONED.replace("_ingested_at date", "_ingested_at string")
    return spark.createDataFrame(made, text).withColumn("_ingested_at", entry.F.col("_ingested_at").cast("date"))


def test_a_store_rewrites_only_buckets_with_arriving_keys(spark, tmp_path):
    path = str(tmp_path / "store")
    many = [(i, f"n{i}", "2024-01-01", 0) for i in range(500)]
    first = merge_arrivals(arrivals(spark, *many), path, "id", bucket_rows=10)
    assert int(first.marks["buckets"]) == 50
    late = [(3, "new", "2024-01-02", 0), (4, "older", "2023-12-31", 0), (5, "gone", "2024-01-03", 1), (900, "more", "2024-01-02", 0)]
    then = merge_arrivals(arrivals(spark, *late), path, "id", bucket_rows=10)
    assert 0 < len(versions.changed(first.folders, then.folders)) <= 3
    stored = {r.id: r.name for r in versions.read(spark, path).collect()}
    assert stored == {i: f"n{i}" for i in range(500)} | {3: "new", 900: "more"}
    assert then.marks["newest"] == "2024-01-03"
    # rows of the newest day may still come, older ones have been seen
    rest = unseen(arrivals(spark, *late), then)
    assert [r.id for r in rest.collect()] == [5]
    again = merge_arrivals(arrivals(spark, *late), path, "id")
    assert {r.id: r.name for r in versions.read(spark, path, again).collect()} == stored


def test_stores_without_rows(spark, tmp_path):
    path = str(tmp_path / "store")
    state = merge_arrivals(arrivals(spark, (1, "a", "2024-01-01", 0)).limit(0), path, "id")
    assert versions.read(spark, path, state).count() == 0
    merge_arrivals(arrivals(spark, (1, "a", "2024-01-01", 0)), path, "id")
    assert [r.id for r in versions.read(spark, path).collect()] == [1]


def test_another_day_rewrites_what_depends_on_it(spark, tmp_path):
    path, source = str(tmp_path), tpch_source(spark, DATA)
    Warehouse(spark, source, entry.AS_OF, entry.CALENDAR).publish(path, ["ods_clients"])
    later = Warehouse(spark, source, entry.AS_OF.replace(day=20), entry.CALENDAR)
    expected = rows(later.ods_clients, "client_id", "days_since_registration")
    later.publish(path, ["ods_clients"])
    assert rows(versions.read(spark, f"{path}/ods_clients"), "client_id", "days_since_registration") == expected


def test_reach_of_months():
    assert refresh.years_of([200012, 200101, 0]) == [0, 2000, 2001]
    assert refresh.years_of_periods([200101]) == [2000, 2001]
    assert refresh.years_of_periods([200012, 0]) == [0, 2000]
    assert refresh.months_of_periods([0, 2000]) == [(0, 0), (200001, 200101)]


def test_postings_are_laid_out_before_they_get_their_account(spark, tmp_path, monkeypatch):
    made = {}
    replace = versions.replace

    def noted(df, path, *rest, **more):
        made[os.path.basename(path)] = df._jdf.queryExecution().optimizedPlan().toString()
        return replace(df, path, *rest, **more)

    monkeypatch.setattr(versions, "replace", noted)
    source = tpch_source(spark, DATA)
    Warehouse(spark, source, entry.AS_OF, entry.CALENDAR).publish(str(tmp_path), ["ods_accounts", "ods_gl_postings"])
    text = made["ods_gl_postings"]
    assert 0 <= text.index("Join LeftOuter") < text.index("RebalancePartitions")
    found = versions.read(spark, str(tmp_path / "ods_gl_postings"))
    table = Warehouse(spark, source, entry.AS_OF, entry.CALENDAR).ods_gl_postings
    assert found.drop("_loaded_at_ts", "ym").columns == table.columns
    assert rows(found, *table.columns) == rows(table)
    assert found.where("ym != coalesce(year(posting_date) * 100 + month(posting_date), 0)").isEmpty()
    # one file a month: the rows stayed where the layout had put them
    assert found.select("ym", F.input_file_name()).distinct().groupBy("ym").count().where("count > 1").isEmpty()
    assert all(name.endswith(".zstd.parquet") for name in map(os.path.basename, found.inputFiles()))
