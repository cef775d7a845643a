"""Every registered query with a SQL twin, over the whole smallest tables."""

import pytest

from checks.catalogue import CHECKS
from checks.run import compare

import __spark_entry__ as contract

WITH_SQL = [name for name, check in CHECKS.items() if check.sql is not None and not name.startswith("m15")]


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(name, spark, duck, sf_dir):
    same, note = compare(name, spark, duck, sf_dir)
    assert same, note


def test_contract(spark, sf_dir):
    assert contract.entry(spark).columns[:2] == ["ref_month", "area_id"]
    assert set(contract.oracle_sql()) < set(contract.queries())


def test_plans_have_no_cross_join(spark, sf_dir):
    for name in ("fs_market_risk", "fs_portfolio", "silver_policies", "w6_share_of_total", "e_all_metrics"):
        plan = CHECKS[name].query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
