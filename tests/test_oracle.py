"""Every registered query equals its independent SQL oracle (DuckDB)."""

import pytest

from starloom.plans.compare import compare_one
from starloom.plans.registry import REGISTRY

from .conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in REGISTRY.items() if sql))
def test_query_matches_oracle(spark, name):
    r = compare_one(spark, SF_SMALL, name)
    assert r["columns_match"], r
    assert r["types_match"], r
    assert r["values_match"], r
    assert r["spark_rows"] == r["oracle_rows"]


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["segment", "net_revenue_point_in_time", "net_revenue_restated_current", "delta"]
    assert df.count() >= 0
    assert set(e.oracle_sql()) <= set(e.queries())
