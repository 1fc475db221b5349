from helpers import day, rows

from finmarts.operators.changes import previous_month, year_to_date


def test_previous_month_skips_gaps(spark):
    data = [(1, day("2024-01-01"), 10), (1, day("2024-02-01"), 12), (1, day("2024-04-01"), 20), (2, day("2024-02-01"), 5)]
    df = spark.createDataFrame(data, "k int, period date, v int")
    got = previous_month(df, ["k"], "period", {"prev": "v"})
    assert rows(got, "k", "period", "prev") == [
        (1, day("2024-01-01"), None), (1, day("2024-02-01"), 10), (1, day("2024-04-01"), None), (2, day("2024-02-01"), None),
    ]


def test_previous_month_on_month_ends(spark):
    ends = ["2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30"]
    df = spark.createDataFrame([(1, day(d), i) for i, d in enumerate(ends)], "k int, period date, v int")
    got = previous_month(df, ["k"], "period", {"prev": "v"}, month_ends=True)
    assert [r[1] for r in rows(got, "period", "prev")] == [None, 0, 1, 2]


def test_year_to_date_restarts(spark):
    data = [(2023, day("2023-12-01"), 5), (2024, day("2024-01-01"), 1), (2024, day("2024-02-01"), 2)]
    df = spark.createDataFrame(data, "y int, period date, v int")
    got = df.select("period", year_to_date("v", ["y"], "period").cast("int").alias("ytd"))
    assert [r[1] for r in rows(got)] == [5, 1, 3]
