"""Every registered query against its SQL at the smallest scale."""

import pytest

from __spark_entry__ import entry
from feedkit.catalog.oracles import ORACLES
from feedkit.catalog.queries import QUERIES
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_registry():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"scan_files"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        assert compare(got, duck.execute(ORACLES[name]).df()) == ""
    assert len(got) > 0


def test_entry(spark):
    assert entry(spark).count() == 20
