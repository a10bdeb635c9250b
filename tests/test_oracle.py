"""Every registered query against its DuckDB twin at sf0.01 (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_ORACLE
from tests.oracle_harness import compare

KEYS = sorted(E.queries())
SQL = E.oracle_sql()


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, key):
    res = compare(spark, SF_ORACLE, key, E.queries()[key], SQL.get(key))
    if key not in SQL:
        assert res["rows"] >= 0
        return
    assert res["rows"] == res["oracle_rows"], res
    assert res["schema_ok"], res
    assert res["values_ok"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["order_date", "daily_revenue", "daily_orders", "daily_buyers", "running_revenue"]


def test_every_query_of_the_models_has_an_oracle():
    from daybook.plans import registered
    assert set(registered.QUERIES) <= set(SQL)
