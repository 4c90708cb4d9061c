"""The registered queries against their SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from silvermill.plans.oracle import all_sql
from silvermill.plans.queries import all_queries
from tools.check_oracle import compare


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["order_key", "id", "name"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, star, name):
    verdict, count, _ = compare(spark, star, name)
    assert verdict == "ok" and count > 0
