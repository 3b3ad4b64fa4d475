"""Dealt queries against their SQL on the smallest tables."""

import pytest
from conftest import SF, oracle_rows, rows_of

from sparley.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert rows_of(queries.QUERIES[name](spark, SF)) == oracle_rows(queries.ORACLES[name])


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 11)]


@pytest.mark.parametrize("name", ["op5_quality_rules", "op8_mixing", "op9_licenses"])
def test_native_plans_have_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
