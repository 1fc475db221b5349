"""Identities of the statements, and the cash-flow and balance formulas on hand-made months."""

from decimal import Decimal

import pytest
from helpers import DATA, day, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from finmarts.plans import balance, cashflow, monthly, pnl

BALANCE = "period date, account_id int, bs_group string, scenario_id int, ending_balance decimal(28,2)"


def month(end, ca, nca, cl, ncl, eq):
    groups = ["current_assets", "noncurrent_assets", "current_liabilities", "noncurrent_liabilities", "equity"]
    return [(day(end), i, g, 1, Decimal(v)) for i, (g, v) in enumerate(zip(groups, (ca, nca, cl, ncl, eq)))]


def test_balance_check_and_ratios(spark):
    data = [
        *month("2024-01-31", "100.00", "50.00", "60.00", "40.00", "50.00"),
        *month("2024-02-29", "100.50", "50.00", "60.00", "40.00", "50.00"),
        *month("2024-03-31", "150.00", "50.00", "0.00", "100.00", "50.00"),
    ]
    sheet = balance.monthly(spark.createDataFrame(data, BALANCE))
    got = rows(sheet, "month", "balance_diff", "is_balanced", "current_ratio", "debt_to_equity", "equity_ratio", "scenario_name")
    assert got == [
        (1, Decimal("0.00"), 1, 1.67, 2.0, 33.33, "Факт"),
        (2, Decimal("0.50"), 1, 1.68, 2.0, 33.22, "Факт"),
        (3, Decimal("50.00"), 0, None, 2.0, 25.0, "Факт"),
    ]


def test_cash_flow_over_a_gap(spark):
    sheet = spark.createDataFrame(
        [
            *month("2024-01-31", "100.00", "50.00", "30.00", "0.00", "0.00"),
            *month("2024-02-29", "120.00", "55.00", "37.00", "0.00", "0.00"),
            *month("2024-04-30", "90.00", "10.00", "5.00", "0.00", "0.00"),
        ],
        BALANCE,
    )
    profit = spark.createDataFrame(
        [
            (day(f"2024-{m:02d}-01"), i, g, 1, Decimal(v))
            for m in (1, 2, 3, 4)
            for i, (g, v) in enumerate([("revenue", "200.00"), ("cogs", "-80.00"), ("depreciation", "-7.00"), ("opex", "-9.00")])
        ],
        "period date, account_id int, pl_group string, scenario_id int, total_signed decimal(28,2)",
    )
    got = {r.month: r for r in cashflow.monthly(profit, sheet).collect()}
    february = got[2]
    assert (february.net_profit, february.depreciation) == (120, 7)
    assert (february.delta_ar, february.delta_ap, february.delta_inventory) == (20, 7, 15)
    assert february.operating_cf == 120 + 7 - 20 + 7 - 15
    assert february.investing_cf == -(5 - 7)
    assert february.net_cash_flow == february.operating_cf + february.investing_cf
    assert (february.opening_cash, february.closing_cash) == (100, 120)
    # no balance in March: no movement; April has no month before it, so nothing was there
    assert (got[3].delta_ar, got[3].operating_cf, got[3].closing_cash) == (0, 127, 0)
    assert (got[4].opening_cash, got[4].delta_ar) == (0, 90)
    assert got[4].net_cash_flow_ytd == sum(got[m].net_cash_flow for m in (1, 2, 3, 4))


@pytest.fixture(scope="module")
def report(spark):
    computed = entry.warehouse(spark, DATA).dm_pnl_periodic
    return spark.createDataFrame(computed.collect(), computed.schema)


def test_waterfall_adds_up(report):
    broken = report.where(
        "gross_profit != revenue - cogs or ebitda != gross_profit - opex or ebit != ebitda - depreciation "
        "or ebt != ebit - financial_exp or net_profit != ebt - tax"
    )
    assert broken.count() == 0


def test_months_add_up_to_quarters_and_weeks(report):
    by_grain = {
        kind: rows(report.where(F.col("period_type") == kind).groupBy("year", "quarter", "scenario_id").agg(F.sum("net_profit")))
        for kind in ("week", "month", "quarter")
    }
    assert by_grain["week"] == by_grain["month"] == by_grain["quarter"]


def test_year_to_date_only_on_months(report):
    assert report.where("period_type != 'month' and revenue_ytd is not null").count() == 0
    assert report.where("period_type = 'month' and revenue_ytd is null").count() == 0


def test_month_rows_agree_with_the_monthly_route(spark, report):
    monthly = pnl.monthly(entry.warehouse(spark, DATA).int_pnl_monthly)
    columns = monthly.columns
    assert rows(report.where("period_type = 'month'"), *columns) == rows(monthly)


def test_aging_buckets_add_up_to_outstanding(spark):
    report = entry.warehouse(spark, DATA).dm_working_capital_monthly
    buckets = "bucket_current + bucket_1_30 + bucket_31_60 + bucket_61_90 + bucket_90plus"
    assert report.where(f"total_outstanding != {buckets} or outstanding_ar + outstanding_ap != total_outstanding").count() == 0


def test_ledger_is_read_once_for_the_pnl(spark):
    text = entry.warehouse(spark, DATA).dm_pnl_periodic._jdf.queryExecution().executedPlan().toString()
    assert text.count("lineitem.parquet") == 1
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_daily_sums_serve_the_periodic_and_the_monthly_statements(spark):
    marts = entry.warehouse(spark, DATA)
    ledger = marts.fct_gl_entry.withColumns({
        "posting_date": F.expr("if(gl_id % 9 = 0, null, posting_date)"),
        "signed_amount": F.expr("if(gl_id % 7 = 0, null, signed_amount)"),
    }).persist()
    daily = monthly.gl_daily(ledger)
    assert daily.agg(F.sum("posting_count")).first()[0] == ledger.count()
    assert rows(pnl.periodic(daily, "total_signed")) == rows(pnl.periodic(ledger))
    assert rows(monthly.gl_months_of_days(daily)) == rows(monthly.gl_monthly(ledger))


def test_checks_of_the_marts_read_the_ledger_once(spark):
    marts = entry.warehouse(spark, DATA)
    checked = marts.checks("dm_pnl_periodic").unionByName(marts.checks("dm_balance_monthly"))
    assert rows(checked, "failing_rows") and "gl_daily" in marts.__dict__ and marts.gl_daily.is_cached
    assert not marts.gl_monthly.is_cached
    marts.release()
    assert "gl_daily" not in marts.__dict__
