from decimal import Decimal

from pyspark.sql import functions as F

from finmarts.functions import rules
from finmarts.functions.numeric import percent, safe_ratio, sum_if


def values(spark, schema, data, column):
    return [r[0] for r in spark.createDataFrame(data, schema).select(column).collect()]


def test_aging_edges_and_risk(spark):
    days = [(-5,), (0,), (1,), (30,), (31,), (60,), (61,), (90,), (91,), (None,)]
    buckets = values(spark, "d int", days, rules.aging_bucket(F.col("d")))
    assert buckets == ["Current", "Current", "1-30d", "1-30d", "31-60d", "31-60d", "61-90d", "61-90d", "90d+", "Current"]
    risks = values(spark, "b string", [("Current",), ("31-60d",), ("90d+",), ("?",)], rules.risk_level(F.col("b")))
    assert risks == ["low", "medium", "high", "unknown"]


def test_ratios_survive_zero_and_null(spark):
    data = [(Decimal("1.00"), Decimal("3.00")), (Decimal("1.00"), Decimal("0.00")), (None, Decimal("2.00")),
            (Decimal("-1.00"), Decimal("3.00"))]
    schema = "a decimal(18,2), b decimal(18,2)"
    assert values(spark, schema, data, percent("a", "b", 1)) == [33.3, None, None, -33.3]
    assert values(spark, schema, data, safe_ratio("a", "b")) == [0.33, None, None, -0.33]


def test_tenure_and_margin_edges(spark):
    assert values(spark, "d int", [(364,), (365,), (1094,), (1095,), (1824,), (1825,)], rules.tenure_group(F.col("d"))) == [
        "<1yr", "1-3yr", "1-3yr", "3-5yr", "3-5yr", "5+yr",
    ]
    assert values(spark, "m double", [(25.0,), (24.99,), (15.0,), (14.99,), (None,)], rules.margin_group(F.col("m"))) == [
        "high", "mid", "mid", "low", "low",
    ]


def test_group_codes_get_one_spelling(spark):
    codes = [("Revenue",), (" OPEX ",), ("Non_Current_Assets",), ("noncurrent_liabilities",), (None,)]
    assert values(spark, "g string", codes, rules.group_code("g")) == [
        "revenue", "opex", "noncurrent_assets", "noncurrent_liabilities", None,
    ]


def test_account_path_takes_the_first_filled_group(spark):
    data = [("pl", "revenue", None, "x"), ("bs", " ", "equity", ""), ("bs", None, "", "Operating"), ("bs", None, None, None)]
    path = rules.account_path("s", "p", "b", "c")
    assert values(spark, "s string, p string, b string, c string", data, path) == [
        "pl / revenue", "bs / equity", "bs / Operating", "bs / Other",
    ]


def test_fiscal_year_and_blank_dates(spark):
    assert values(spark, "m int", [(1,), (2,), (12,)], rules.fiscal_year_end(F.col("m"))) == [12, 1, 11]
    assert values(spark, "d string", [("",), ("2024-02-30",), (None,)], rules.day("d")) == [None, None, None]


def test_delivery_and_signs(spark):
    data = [(0, "x"), (1, "x"), (None, None)]
    on_time = rules.on_time(F.col("delay"), F.col("delivered"))
    assert values(spark, "delay int, delivered string", data, on_time) == [1, 0, None]
    signed = rules.signed_amount(F.col("a"), F.col("s"))
    assert values(spark, "a decimal(18,2), s int", [(Decimal("2.50"), -1), (Decimal("2.50"), None)], signed) == [
        Decimal("-2.50"), None,
    ]


def test_conditional_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(1, Decimal("1.00"))], "k int, v decimal(18,2)")
    assert df.agg(sum_if("v", F.col("k") == 2)).first()[0] == Decimal("0.00")
