"""Every registered query against its SQL on the smallest tables."""

import pytest

from checks.compare import difference, oracle
from checks.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert name in SQL
    assert difference(spark, con, name, SF) is None


def test_entry():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
