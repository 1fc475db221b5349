"""A refresh of order lines makes again what has changed and equals a full build, whatever has changed."""

import shutil
from decimal import Decimal

import pytest
from helpers import day, rows
from pyspark.sql import functions as F

from finmarts.operators.ranges import MOST_RANGES, NO_KEY, Ranges, noted, ranges_of
from finmarts.plans.warehouse import Warehouse
from finmarts.sources import files, versions
from finmarts.sources.schemas import schema_of
from finmarts.sources.sinks import MONTH, partition_of

TABLES = ["ods_sales_orders", "ods_sales_order_lines"]
MONTHS = ["2024-01-10", "2024-02-10", "2024-03-10", None]


def order(i, date, loaded="2024-06-01", deleted=0):
    when = day(date) if date else None
    return {
        "order_id": i, "client_id": 1, "order_date": when, "shipment_date": when, "status": "ok", "total_amount": Decimal(5),
        "_row_hash": f"o{i}{date}", "_batch_id": "b", "_ingested_at": day(loaded), "_is_deleted": deleted,
    }


def line(i, of, quantity=1, loaded="2024-06-01", deleted=0):
    return {
        "order_line_id": i, "order_id": of, "product_id": 1, "quantity": quantity, "line_revenue": Decimal(2),
        "line_gross_profit": Decimal(1), "_row_hash": f"l{i}{quantity}", "_batch_id": "b", "_ingested_at": day(loaded),
        "_is_deleted": deleted,
    }


ORDERS = {i: order(i, MONTHS[i % 4]) for i in range(1, 41)}
LINES = {i: line(i, i // 10) for i in range(10, 440)}  # orders above 40 are not there


def source(spark, orders, lines):
    held = {"stg_sales_orders": orders, "stg_sales_order_lines": lines}
    return lambda t: spark.createDataFrame(list(held[t]), schema_of(t))


def published(spark, path, orders, lines):
    marts = Warehouse(spark, source(spark, orders, lines), day("2024-07-01"))
    marts.publish(path, TABLES)
    return versions.manifest(spark, f"{path}/ods_sales_order_lines")


def as_built(spark, orders, lines):
    """Every line with the month of its order, by a full build."""
    marts = Warehouse(spark, source(spark, orders, lines), day("2024-07-01"))
    months = marts.ods_sales_orders.select("order_id", partition_of(MONTH, F.col("order_date")).alias(MONTH))
    return rows(marts.ods_sales_order_lines.join(months, "order_id", "left").fillna(0, MONTH))


@pytest.fixture(scope="module")
def begun(spark, tmp_path_factory):
    """A folder in which the lines have been published once."""
    path = str(tmp_path_factory.mktemp("begun") / "marts")
    published(spark, path, ORDERS.values(), LINES.values())
    return path


def stored(spark, path):
    found = versions.read(spark, f"{path}/ods_sales_order_lines")
    return rows(found.drop("_loaded_at_ts"))


CHANGES = {
    "nothing": (ORDERS, LINES, []),
    "new lines of a new order": (ORDERS | {43: order(43, "2024-03-20")}, LINES | {i: line(i, 43) for i in range(440, 450)}, [0, 202403]),
    "a line loaded long ago has changed": (ORDERS, LINES | {15: line(15, 1, 7, "2020-01-01")}, [202402]),
    "a line is gone": (ORDERS, {i: x for i, x in LINES.items() if i != 25}, [202403]),
    "a line is deleted": (ORDERS, LINES | {25: line(25, 2, deleted=1)}, [202403]),
    "a line goes to another order": (ORDERS, LINES | {25: line(25, 1, 3)}, [202402, 202403]),
    "an order gets another date": (ORDERS | {2: order(2, "2024-01-11")}, LINES, [202401, 202403]),
    "an order comes to lines that were there": (ORDERS | {41: order(41, "2024-05-01")}, LINES, [0, 202405]),
    "an order is gone": ({i: x for i, x in ORDERS.items() if i != 4}, LINES, [0, 202401]),
    "an order loses its date": (ORDERS | {5: order(5, None)}, LINES, [0, 202402]),
    "a line without a key": (ORDERS, LINES | {None: line(None, 1, 9)}, [202402]),
    "lines of two states": (ORDERS, [*LINES.values(), line(30, 3, 8, "2024-06-02"), line(31, 3, 8, "2024-05-02")], [0]),
}


@pytest.mark.parametrize("change", CHANGES)
def test_a_refresh_equals_a_full_build(spark, tmp_path, begun, change):
    path = str(tmp_path / "marts")
    shutil.copytree(begun, path)
    first = versions.manifest(spark, f"{path}/ods_sales_order_lines")
    orders, lines, months = CHANGES[change]
    lines = lines if isinstance(lines, list) else list(lines.values())
    then = published(spark, path, orders.values(), lines)
    assert versions.changed(first.folders, then.folders) == months
    assert stored(spark, path) == as_built(spark, orders.values(), lines)
    assert not [n for n in files.names(spark, f"{path}/ods_sales_order_lines") if n.startswith("_batch")]
    # a fact finds the lines laid out by the headers in force
    assert then.sources["ods_sales_orders"] == versions.manifest(spark, f"{path}/ods_sales_orders").folders


def test_more_refreshes_equal_a_full_build(spark, tmp_path):
    path, orders, lines = str(tmp_path / "marts"), dict(ORDERS), dict(LINES)
    published(spark, path, orders.values(), lines.values())
    for i in range(4):
        orders[50 + i] = order(50 + i, f"2024-0{4 + i}-01")
        orders[3 + i] = order(3 + i, "2024-02-20")
        lines |= {n: line(n, 50 + i) for n in range(500 + 10 * i, 510 + 10 * i)} | {100 + i: line(100 + i, 2, 5)}
        published(spark, path, orders.values(), lines.values())
    assert stored(spark, path) == as_built(spark, orders.values(), lines.values())


def test_where_the_old_headers_are_gone_all_lines_are_made_again(spark, tmp_path):
    path = str(tmp_path / "marts")
    first = published(spark, path, ORDERS.values(), LINES.values())
    for i in range(versions.KEPT + 1):
        moved = ORDERS | {6: order(6, f"2024-04-0{i + 1}")}
        Warehouse(spark, source(spark, moved.values(), LINES.values()), day("2024-07-01")).publish(path, TABLES[:1])
    then = published(spark, path, moved.values(), LINES.values())
    assert set(first.folders.values()).isdisjoint(then.folders.values())
    assert stored(spark, path) == as_built(spark, moved.values(), LINES.values())


def test_ranges(spark):
    def found(*data, before=None):
        return ranges_of(spark.createDataFrame(list(data), "k long, x string"), "k", before)

    many = [(i, f"x{i}") for i in range(-3000, 3000)]
    first = found(*many)
    assert first.width == 6 and noted(first.marks()) == first and len(first.sums) < 1100
    assert found(*reversed(many)).changed(first) == []
    assert found(*many, (50, "x50")).changed(first) == [8]
    assert found(*many[:-1], (2999, "other")).changed(first) == [499]
    assert found(*many, (None, "x")).changed(first) == [NO_KEY]
    assert found(*many[6:]).changed(first) == [-500, -499]
    more = found(*many, (6 * MOST_RANGES, "far"), before=first)
    assert more.width > first.width
    assert found().sums == {} and noted({}) is None
    assert found((None, "x"), (None, "y")).sums.keys() == {NO_KEY}
    assert Ranges(2, {1: "a"}).changed(Ranges(2, {2: "a"})) == [1, 2]
