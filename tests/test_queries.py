"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from parcelspark.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
# The text operators have their own tests.
UNCHECKED = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", UNCHECKED)
def test_query_without_sql_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["property_type", "n", "avg_price", "avg_log_size"]
    assert df.count() > 0
