from decimal import Decimal

import pytest
from helpers import day, rows
from pyspark.sql import functions as F

from finmarts.operators.checks import Checks, Newest, run_checks, run_newest_checks
from finmarts.plans.expectations import EXPECTATIONS
from finmarts.plans.warehouse import CHECKED_BELOW, CLEANED, FACTS, MARTS, TABLES, Warehouse
from finmarts.sources.schemas import schema_of


def test_every_kind_of_failure_is_counted(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "b", -1), (2, "x", None), (None, None, 5), (None, "a", 0)], "id int, code string, v int"
    )
    checks = Checks(not_null=["id", "code"], unique=["id", "code"], accepted={"code": ["a", "b"]}, conditions={"v_ok": "v >= 0"})
    assert rows(run_checks(df, "t", checks)) == [
        ("t", "accepted_values", "code", 1),
        ("t", "expression_is_true", "v_ok", 1),
        ("t", "not_null", "code", 1),
        ("t", "not_null", "id", 2),
        ("t", "unique", "code", 1),
        ("t", "unique", "id", 1),
    ]


def test_empty_table_has_no_failures(spark):
    df = spark.createDataFrame([], "id int")
    assert rows(run_checks(df, "t", Checks(not_null=["id"], unique=["id"]))) == [
        ("t", "not_null", "id", 0), ("t", "unique", "id", 0),
    ]


def test_tables_have_expectations():
    assert set(TABLES) - set(EXPECTATIONS) == {"int_pnl_monthly", "int_balance_monthly", "int_sales_monthly"}


def test_every_expected_check_is_declared():
    import oracle
    from finmarts.plans.expectations import EXPECTATIONS

    declared = {
        t: (list(c.not_null), list(c.unique), {k: list(v) for k, v in c.accepted.items()}, dict(c.conditions))
        for t, c in EXPECTATIONS.items()
    }
    expected = {t: (f.split(), u.split(), a, c) for t, (f, u, a, c) in oracle.CHECKS.items()}
    assert declared == expected


def test_a_table_is_planned_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id % 7 as k", "if(id = 3, null, 'x') as s").write.parquet(path)
    checks = Checks(not_null=["s", "id"], unique=["id", "k"], accepted={"s": ["x"]}, conditions={"small": "id < 98"})
    found = run_checks(spark.read.parquet(path), "t", checks)
    assert rows(found, "check_name", "column_name", "failing_rows") == [
        ("accepted_values", "s", 0), ("expression_is_true", "small", 2), ("not_null", "id", 0), ("not_null", "s", 1),
        ("unique", "id", 0), ("unique", "k", 7),
    ]
    assert found._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1


def test_checks_of_an_empty_table(spark):
    empty = spark.range(0).selectExpr("id", "'x' as s")
    found = run_checks(empty, "t", Checks(not_null=["s"], unique=["id"]))
    assert rows(found, "check_name", "failing_rows") == [("not_null", 0), ("unique", 0)]


def odd_loads(spark, staging):
    """Two loads of each key with nulls, unknown codes and negative amounts here and there; some are deleted, some tie."""
    odd = {"bigint": "id % 5", "int": "id % 4", "date": "date_add(date'2000-01-01', cast(id % 50 as int))",
           "string": "element_at(array(' ar', 'AP ', 'paid', 'odd', ''), cast(id % 5 as int) + 1)",
           "decimal(18,2)": "cast(id % 7 - 2 as decimal(18,2))"}
    load = {"_row_hash": "if(id % 3 = 0, 'no hex', md5(cast(id as string)))", "_batch_id": "concat('b', id % 2)",
            "_ingested_at": "date_add(date'2000-01-01', cast(id % 3 as int))", "_is_deleted": "if(id % 8 = 0, 1, 0)",
            "_source_system": "'x'"}
    columns = []
    for i, field in enumerate(schema_of(staging)):
        kind = field.dataType.simpleString()
        value = load.get(field.name) or f"if((id + {i}) % 6 = 0, null, {odd.get(kind, 'id % 3')})"
        value = "if(id < 6, null, id % 60)" if i == 0 else value
        columns.append(f"cast({value} as {kind}) as {field.name}")
    return spark.range(0, 120, 1, 4).selectExpr(*columns)


@pytest.mark.parametrize("name", sorted(CLEANED))
def test_checks_of_a_clean_table_find_what_its_rows_show(spark, name):
    def source(staging):
        return odd_loads(spark, staging).persist()

    def made():
        return Warehouse(spark, source, day("2001-08-01"))

    found = rows(made().checks(name))
    assert found == rows(run_checks(made().table(name), name, EXPECTATIONS[name]))
    assert any(failing for *_, failing in found)


def test_only_keys_and_failures_travel_to_the_newest_rows(spark, plan, tmp_path):
    odd_loads(spark, "stg_sales_order_lines").write.parquet(str(tmp_path / "t"))
    tables = Warehouse(spark, lambda _: spark.read.parquet(str(tmp_path / "t")), day("2001-08-01"))
    text = plan(tables.checks("ods_sales_order_lines")).split("Initial Plan")[0]
    shuffles = [line for line in text.splitlines() if " Exchange " in line]
    # one by key, and one for the totals
    assert len(shuffles) == 2 and sum("hashpartitioning(order_line_id" in s for s in shuffles) == 1
    sent = text[text.rindex(" Exchange "):].splitlines()[1]
    assert "_failed" in sent and "CASE WHEN isnull(product_id" in sent


@pytest.mark.parametrize("name", FACTS)
def test_checks_of_a_fact_find_what_its_rows_show(spark, name):
    def source(staging):
        return odd_loads(spark, staging).persist()

    def made():
        return Warehouse(spark, source, day("2001-08-01"))

    found = rows(made().checks(name))
    assert found == rows(run_checks(made().table(name), name, EXPECTATIONS[name]))
    assert any(failing for *_, failing in found)


@pytest.mark.parametrize("name", FACTS)
def test_only_keys_and_failures_of_a_fact_travel(spark, plan, tmp_path, name):
    def source(staging):
        path = str(tmp_path / staging)
        odd_loads(spark, staging).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(Warehouse(spark, source, day("2001-08-01")).checks(name)).split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    below, _ = CHECKED_BELOW[name]
    # lookups are met where the rows are; lines move to their header
    assert text.count("SortMergeJoin") == len(below) - 1 + (name == "fct_gl_entry")  # the accounts of postings
    keyed = [line for line in text.splitlines() if f"hashpartitioning({CLEANED[below[0]][1]}" in line]
    assert len(keyed) == 1 and "_failed" in text


@pytest.mark.parametrize("name", [t for t in MARTS if t in EXPECTATIONS])
def test_checks_of_a_mart_find_what_its_rows_show(spark, name):
    def source(staging):
        return odd_loads(spark, staging).persist()

    def made():
        return Warehouse(spark, source, day("2001-08-01"))

    assert rows(made().checks(name)) == rows(run_checks(made().table(name), name, EXPECTATIONS[name]))


def test_both_reports_on_invoices_are_checked_on_one_pass(spark, plan, tmp_path):
    def source(staging):
        path = str(tmp_path / staging)
        odd_loads(spark, staging).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    tables = Warehouse(spark, source, day("2001-08-01"))
    both = tables.checks("dm_working_capital_monthly").unionByName(tables.checks("dm_ar_ap_aging_snapshot"))
    text = plan(both).split("Initial Plan")[0]
    sent = [line for line in text.splitlines() if "hashpartitioning(invoice_id" in line and "REPARTITION_BY_COL" in line]
    assert len([line for line in sent if "Reused" not in line]) == 1 and "ReusedExchange" in text


def test_rows_that_a_repeated_lookup_key_adds_are_counted(spark):
    load = ["date'2000-01-01' as _ingested_at", "'b' as _batch_id", "md5('x') as _row_hash", "0 as _is_deleted"]
    lines = spark.range(6).selectExpr("id as line", "id % 3 as order", "id % 2 as part", "if(id = 4, null, 1) as v", *load)
    orders = spark.range(2).selectExpr("id as order", "if(id = 0, null, id) as buyer", "id as region", *load)
    parts = spark.createDataFrame([(0,), (0,), (0,), (1,), (None,), (None,)], "part bigint")
    regions = spark.createDataFrame([(0,), (1,), (1,)], "region bigint")
    checks = Checks(not_null=["line", "v", "buyer"], unique=["line"], conditions={"first": "line < 3"})
    found = run_newest_checks(
        Newest(lambda keep, also: keep(lines, ["line"]).select("line", "order", "part", "v", *also), "line", [(parts, ["part"])]),
        "t", checks,
        Newest(lambda keep, also: keep(orders, ["order"]).select("order", "buyer", "region", *also), "order", [(regions, ["region"])]),
        of_header=["buyer"],
    )
    joined = lines.drop("_is_deleted").join(parts, "part", "left").join(orders.join(regions, "region", "left").select("order", "buyer"), "order")
    assert rows(found) == rows(run_checks(joined, "t", checks))
    assert [r.failing_rows for r in found.where("check_name = 'unique'").collect()] == [3]


def test_one_key_counts_as_its_text_does(spark):
    df = spark.createDataFrame([(1, Decimal(1)), (1, Decimal(1)), (1, None), (2, Decimal(2)), (None, None), (None, None)], "i int, d decimal(5,1)")
    for column in ("i", "d"):
        assert rows(run_checks(df, "t", Checks(unique=[column])), "failing_rows") == [(1,)]
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")
    assert rows(run_checks(zeros, "t", Checks(unique=["x"])), "failing_rows") == [(0,)]
    assert run_checks(df.where(F.lit(False)), "t", Checks(unique=["i"])).first().failing_rows == 0
