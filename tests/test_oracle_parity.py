"""Every registered query against its DuckDB twin (row count, columns, values)."""

import pytest

import __spark_entry__ as E
from tessera.plans.registry import REGISTRY
from tests.compare import compare
from tests.conftest import SF_SMALL

QUERIES = {name: fn for name, fn in E.queries().items() if name in REGISTRY}
SQLS = E.oracle_sql()


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(SQLS))
    assert missing == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_parity(spark, duck, name):
    res = compare(spark, duck, SF_SMALL, name, QUERIES[name], SQLS.get(name))
    assert res["status"] == "OK", res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["CategoryName", "CalendarYear"]
    assert df.count() > 0
