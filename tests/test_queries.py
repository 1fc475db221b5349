"""Every registered query against its DuckDB statement."""

import compare
import pytest
from helpers import DATA

import __spark_entry__ as entry

QUERIES = {n: q for n, q in entry.queries().items() if n not in entry.TEXT_QUERIES}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(DATA)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_expected_result(name, spark, duck):
    assert compare.differences(QUERIES[name](spark, DATA), duck, entry.oracle_sql()[name]) == []


def test_every_query_has_an_expected_result():
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0
