"""Every registered query against DuckDB on the smallest tables, and its plan."""

import pytest

from checks.compare import difference, duck
from checks.queries import ORACLE, QUERIES

from tests.conftest import plan_of

SF = "/root/testdata/sf0.001"

#: Queries whose plan may hold a cross join: totals of one row each.
ONE_ROW_JOINS = {
    "executive_kpis",
    "reconcile_closer",
    "reconcile_inbound",
    "reconcile_outbound",
    "reconcile_objections",
}


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_duckdb(spark, connection, name):
    df = QUERIES[name](spark, SF)
    assert difference(df, connection, name) is None
    plan = plan_of(df)
    assert "Python" not in plan and "Pandas" not in plan
    if name not in ONE_ROW_JOINS:
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_entry_points_cover_each_other():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize(
    "name", ["asof_first_after", "asof_heavy_keys", "fact_lead_funnel", "fact_lead_funnel_heavy"]
)
def test_matching_on_larger_tables(spark, name):
    """Wrong plans for ordered matching have passed on small tables before."""
    larger = "/root/testdata/sf0.1"
    assert difference(QUERIES[name](spark, larger), duck(larger), name) is None
