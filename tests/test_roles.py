"""Roles that Spark makes in a plainer way than their statements."""

import pytest

from locuslake.plans import fixtures

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["win", "depth"])
def test_roles_equal_their_statements(spark, name):
    plain, said = fixtures.role(spark, D, name), fixtures.stated(spark, D, name)
    assert plain.dtypes == said.dtypes
    assert plain.exceptAll(said.select(*plain.columns)).isEmpty() and said.select(*plain.columns).exceptAll(plain).isEmpty()


def test_no_join_sorts_by_an_expression(spark):
    plan = fixtures.role(spark, D, "depth")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
