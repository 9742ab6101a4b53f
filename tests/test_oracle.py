import pytest

import __spark_entry__ as driver
from acceptance.check import difference
from acceptance.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, name):
    assert name in driver.oracle_sql()
    assert difference(spark, SMALL, name) is None


def test_entry(spark):
    assert driver.entry(spark).count() == 20
