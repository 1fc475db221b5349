import time
from decimal import Decimal

import pytest
from helpers import day, rows

from finmarts.sources import versions
from finmarts.streaming.refresh import refresh_from

ARRIVING = "id bigint, d date, amount decimal(18,2), version int"


def test_arriving_files_are_upserted_once(spark, tmp_path):
    inbox, table, checkpoint = (str(tmp_path / n) for n in ("inbox", "table", "checkpoint"))

    def arrive(*data):
        made = spark.createDataFrame([(i, day(d), Decimal(a), v) for i, d, a, v in data], ARRIVING)
        made.coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(ARRIVING).parquet(inbox)
        query = refresh_from(stream, table, "id", "d", checkpoint, order=["version"])
        query.awaitTermination(120)
        assert query.exception() is None

    arrive((1, "2024-01-30", "1.00", 1), (1, "2024-01-31", "1.50", 2), (2, "2024-02-01", "2.00", 1))
    arrive((2, "2024-02-02", "2.20", 2), (3, "2024-01-10", "9.00", 1), (4, "2024-01-31", "4.00", 1))
    arrive((5, "2024-02-03", "5.00", 1))
    assert rows(versions.read(spark, table), "id", "d", "amount") == [
        (1, day("2024-01-31"), Decimal("1.50")),
        (2, day("2024-02-02"), Decimal("2.20")),
        (3, day("2024-01-10"), Decimal("9.00")),  # arrivals are taken whatever their date
        (4, day("2024-01-31"), Decimal("4.00")),
        (5, day("2024-02-03"), Decimal("5.00")),
    ]


DELETABLE = ARRIVING + ", _is_deleted int"


@pytest.mark.parametrize("files_at_once", [1, 100])
@pytest.mark.parametrize("backwards", [False, True])
def test_the_cut_and_order_of_arrivals_do_not_matter(spark, tmp_path, files_at_once, backwards):
    inbox, table, checkpoint = (str(tmp_path / n) for n in ("inbox", "table", "checkpoint"))
    arrivals = [
        [(1, "2024-01-30", "1.00", 1, 0), (2, "2024-03-01", "2.00", 1, 0)],
        [(1, "2024-02-01", "1.50", 2, 0), (3, "2023-01-01", "3.00", 1, 0)],
        [(2, "2024-03-02", "2.50", 3, 1), (4, None, "4.00", 1, 0)],
        [(2, "2024-03-01", "2.20", 2, 0), (4, "2024-05-01", "4.10", 2, 0)],
    ]
    for part in arrivals[::-1] if backwards else arrivals:
        made = spark.createDataFrame([(i, day(d) if d else None, Decimal(a), v, x) for i, d, a, v, x in part], DELETABLE)
        made.coalesce(1).write.mode("append").parquet(inbox)
        time.sleep(0.05)
    stream = spark.readStream.schema(DELETABLE).option("maxFilesPerTrigger", files_at_once).parquet(inbox)
    query = refresh_from(stream, table, "id", "d", checkpoint, order=["version"])
    query.awaitTermination(120)
    assert query.exception() is None
    assert rows(versions.read(spark, table), "id", "d", "amount") == [
        (1, day("2024-02-01"), Decimal("1.50")),
        (2, day("2024-03-01"), Decimal("2.20")),
        (3, day("2023-01-01"), Decimal("3.00")),
        (4, day("2024-05-01"), Decimal("4.10")),
    ]
