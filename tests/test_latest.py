from decimal import Decimal

import pytest
from helpers import day, rows
from pyspark.sql import functions as F

from finmarts.operators.latest import latest, latest_live, replace_by_key, sum_merge

LOAD = "id int, name string, _ingested_at date, _batch_id string, _row_hash string, _is_deleted int"


@pytest.fixture
def loads(spark):
    return spark.createDataFrame(
        [
            (1, "old", day("2024-01-01"), "b1", "h1", 0),
            (1, "new", day("2024-01-02"), "b0", "h0", 0),
            (2, "first batch", day("2024-01-01"), "b1", "h9", 0),
            (2, "second batch", day("2024-01-01"), "b2", "h1", 0),
            (3, "low hash", day("2024-01-01"), "b1", "h1", 0),
            (3, "high hash", day("2024-01-01"), "b1", "h2", 0),
            (4, "revived", day("2024-01-01"), "b1", "h1", 0),
            (4, "deleted", day("2024-01-02"), "b1", "h1", 1),
            (5, "gone", day("2024-01-01"), "b1", "h1", 1),
        ],
        LOAD,
    )


def test_newest_wins_and_ties_are_decided(loads):
    expected = [(1, "new"), (2, "second batch"), (3, "high hash"), (4, "revived")]
    assert rows(latest_live(loads, ["id"]), "id", "name") == expected


def test_tombstone_can_remove_the_key(loads):
    kept = latest_live(loads, ["id"], tombstone_wins=True)
    assert [r[0] for r in rows(kept, "id")] == [1, 2, 3]


def test_each_key_is_cut_to_one_row_before_the_shuffle(spark, plan):
    hot = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    result = latest(hot, ["k"], ["v"])
    text = plan(result)
    before_shuffle = text[text.rindex("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert result.where("k = 0").first().v == 29997
    assert result.count() == 20001


def test_replace_by_key_prefers_higher_version_then_incoming(spark):
    current = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "k int, v string, ver int")
    incoming = spark.createDataFrame([(1, "A", 11), (2, "B", 20), (3, "C", 29), (4, "D", 1)], "k int, v string, ver int")
    merged = replace_by_key(current, incoming, ["k"], "ver")
    assert rows(merged) == [(1, "A", 11), (2, "B", 20), (3, "c", 30), (4, "D", 1)]


def test_sum_merge_adds_partial_rows(spark):
    schema = "k int, amount decimal(18,2), n bigint"
    a = spark.createDataFrame([(1, Decimal("1.10"), 1), (2, Decimal("2.00"), 1)], schema)
    b = spark.createDataFrame([(1, Decimal("0.90"), 2)], schema)
    assert rows(sum_merge([a, b], ["k"], ["amount", "n"])) == [(1, Decimal("2.00"), 3), (2, Decimal("2.00"), 1)]


def test_sum_merge_refuses_ratios_and_undeclared_columns(spark):
    part = spark.createDataFrame([(1, 0.5, 2)], "k int, margin_pct double, n int")
    with pytest.raises(ValueError, match="ratios"):
        sum_merge([part], ["k"], ["margin_pct", "n"])
    with pytest.raises(ValueError, match="neither"):
        sum_merge([part], ["k"], ["n"])


def test_staging_rows_are_sorted_after_the_shuffle_only(spark, plan):
    loads = spark.range(0, 3000, 1, 8).selectExpr(
        "id % 1000 as id", "concat('n', id) as name", "date_add(date'2024-01-01', cast(id / 1000 as int)) as _ingested_at",
        "'b' as _batch_id", "md5(cast(id as string)) as _row_hash", "if(id >= 2990, 1, 0) as _is_deleted",
    )
    found = latest_live(loads, ["id"])
    text = plan(found)
    assert "Exchange" in text and "Sort" not in text[text.rindex("Exchange"):] and "WindowGroupLimit" not in text
    # the newest is deleted for the last ten keys
    assert rows(found, "id", "name") == rows(latest(loads.where("_is_deleted = 0"), ["id"]), "id", "name")
    assert found.count() == 1000 and found.where("id = 995").first().name == "n1995"


def test_rows_without_a_key_and_equal_rows_leave_one(spark):
    row = (None, "a", day("2024-01-01"), "b1", "h1", 0)
    loads = spark.createDataFrame([row, row, (1, "x", None, None, None, 0), (1, "y", day("2024-01-01"), None, None, 0)], LOAD)
    assert rows(latest_live(loads, ["id"]), "id", "name") == [(1, "y"), (None, "a")]


def test_a_hash_of_hex_digits_travels_as_bytes(spark, plan):
    loads = spark.range(0, 4000, 1, 2).selectExpr(
        "id % 3000 as id", "date'2024-01-01' as _ingested_at", "'b' as _batch_id",
        "md5(cast(id as string)) as _row_hash", "0 as _is_deleted",
    )
    found = latest_live(loads, ["id"])
    text = plan(found).split("Initial Plan")[0]
    assert text.count("Exchange") == 1
    before, after = text[text.rindex("Exchange"):], text[:text.rindex("Exchange")]
    assert "_hash_bytes" in before and "unhex" in before
    assert "lower(hex(_hash_bytes" in after
    assert rows(found) == rows(latest(loads, ["id"]))


def test_hashes_are_compared_as_text_however_they_travel(spark):
    hashes = [
        "0f", "f0", "F0", "abc", "abcd", "ABCD", "", None, "zz", "0", "a" * 32, "a" * 31 + "g", "é1", "0g", "ab ", "00\n", "b0 c",
        "a" * 33, "A" * 32, "10", "1", "\u0000",
    ]
    pairs = [(i * 100 + j, f"{h!r} {side}", day("2024-01-01"), "b", h, 0)
             for i, a in enumerate(hashes) for j, b in enumerate(hashes) for side, h in enumerate((a, b)) if a != b]
    loads = spark.createDataFrame(pairs, LOAD)
    found = latest_live(loads, ["id"])
    assert rows(found) == rows(latest(loads, ["id"]))
    expected = {}
    for row in pairs:
        text = (row[4] is not None, (row[4] or "").encode())
        if row[0] not in expected or text > expected[row[0]][0]:
            expected[row[0]] = (text, row[4])
    assert {r.id: r._row_hash for r in found.collect()} == {k: v for k, (_, v) in expected.items()}
