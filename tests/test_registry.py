import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["source", "price_tier", "count", "avg_price", "avg_discount"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, duck, name):
    assert difference(spark, duck, SF, name) is None
