"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from rinkframe.bindings import QUERIES
from tests import oracle

pytestmark = pytest.mark.skipif(
    not oracle.Path(oracle.DEFAULT).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(oracle.DEFAULT)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    assert QUERIES[name].sql, f"{name} has no SQL"
    assert oracle.differences(spark, duck, oracle.DEFAULT, QUERIES[name]) is None


def test_entry_point(spark):
    assert set(QUERIES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())
    result = entry_point.entry(spark)
    assert "home_on_ice_ids" in result.columns and result.limit(1).count() == 1
