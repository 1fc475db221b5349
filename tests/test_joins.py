"""Facts: unmatched keys, polymorphic counterparties and hot keys."""

from decimal import Decimal

import pytest
from helpers import DATA, day, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from finmarts.functions.calendar import CalendarRange
from finmarts.operators.latest import latest
from finmarts.operators.lookups import lookup_side
from finmarts.plans import facts

CALENDAR = CalendarRange(day("2024-01-01"), day("2024-12-31"))


def test_invoice_of_client_supplier_and_unknown(spark):
    invoices = spark.createDataFrame(
        [(1, "client", 7), (2, "supplier", 7), (3, "client", 8), (4, "other", 7)],
        "invoice_id bigint, counterparty_type string, counterparty_id bigint",
    ).withColumns({
        **{c: F.lit("x") for c in ("invoice_code", "invoice_type", "aging_bucket", "status")},
        **{c: F.lit(day("2024-05-05")) for c in ("invoice_date", "due_date")},
        **{c: F.lit(Decimal("1.00")) for c in ("amount", "paid_amount", "outstanding")},
        **{c: F.lit(1) for c in ("days_overdue", "collection_rate", "is_overdue")},
    })
    clients = spark.createDataFrame([(7, "Client 7", "A", "North")], "client_id bigint, client_name string, segment string, region string")
    suppliers = spark.createDataFrame([(7, "Supplier 7")], "supplier_id bigint, supplier_name string")
    got = facts.invoice(invoices, clients, suppliers, CALENDAR)
    assert rows(got, "invoice_id", "counterparty_name", "counterparty_segment", "counterparty_region") == [
        (1, "Client 7", "A", "North"), (2, "Supplier 7", None, None), (3, "Unknown", None, None), (4, "Unknown", None, None),
    ]


@pytest.fixture
def small_skew_limits(spark):
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_of_the_fact_side_is_split(spark, plan, small_skew_limits):
    fact = spark.range(0, 400000, 1, 16).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"), F.hash("id").alias("v")
    )
    versions = spark.range(2000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("version"))
    joined = fact.join(lookup_side(latest(versions, ["k"], ["version"])), "k", "left")
    counted = joined.groupBy((F.col("v") % 5).alias("g")).agg(F.count("version").alias("n"))
    text = plan(counted)
    assert "SortMergeJoin(skew=true)" in text
    assert sum(r.n for r in counted.collect()) == 400000


@pytest.mark.parametrize("name", ["fct_sales_order_line", "fct_purchase_order_line"])
def test_orders_are_not_dealt_out_round_robin(spark, name, small_skew_limits):
    text = entry.warehouse(spark, DATA).table(name)._jdf.queryExecution().executedPlan().toString()
    for line in text.split("\n"):
        if "RoundRobin" in line:
            below = text.split(line)[1].split("Exchange")[0]
            assert "o_orderkey" not in below
