import pytest

import __spark_entry__ as contract
import compare
from workloads import registry

TINY = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(registry.ORACLES) == set(registry.QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_agrees_with_its_sql(spark, name):
    assert compare.differences(spark, TINY, name) == []
