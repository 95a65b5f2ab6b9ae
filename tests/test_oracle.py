"""Every registered query against its SQL, over whole tables of the smallest data set."""

import pytest

import __spark_entry__ as entry
from check import differences, oracle
from terrace.queries.registered import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, duck, name):
    assert name in ORACLES
    assert differences(spark, duck, SF, name) is None


def test_entry(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema and first.count() == second.count() > 0
