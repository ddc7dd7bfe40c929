"""Every named query against its SQL over the same tables."""

import pytest

import __spark_entry__ as entry
from tests.comparing import difference, oracle_connection
from tillroll.catalogue import QUERIES
from tillroll.oracle import ORACLE


@pytest.fixture(scope="module")
def connection(folder):
    return oracle_connection(folder)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, folder, connection, name):
    result = QUERIES[name](spark, folder)
    assert difference(result, connection, ORACLE[name]) is None


def test_flagship_query(spark):
    assert [r["discount_band"] for r in entry.entry(spark).collect()] == [
        "0%",
        "1-10%",
        "11-20%",
        "21-30%",
        "30%+",
    ]
