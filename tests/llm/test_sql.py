import pytest

from murmura.llm.check import difference
from murmura.llm.oracles import ORACLES
from murmura.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert difference(spark, SMALL, name) is None


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
