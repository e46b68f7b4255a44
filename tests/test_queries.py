"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from cuota.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, duck, name):
    assert differences(queries()[name](spark, SF), duck, oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).columns == ["mes", "banco", "producto", "monto_mes", "total_mes", "share_mes"]
