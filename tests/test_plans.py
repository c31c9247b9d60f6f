"""Plan guards for every registered query: no nested-loop or Cartesian
joins, no Python evaluation in the plan."""

import pytest

from starloom.plans.registry import REGISTRY

from .conftest import SF_SMALL

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_plan_has_no_forbidden_operator(spark, name, capsys):
    df = REGISTRY[name][0](spark, SF_SMALL)
    df.explain()
    plan = capsys.readouterr().out
    found = [op for op in FORBIDDEN if op in plan]
    assert not found, f"{name}: {found}"
