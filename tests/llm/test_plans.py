"""Plans of this subpackage's queries."""

from __future__ import annotations

import pytest

from headway.llm.queries import QUERIES
from headway.session import prepare

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op3_benchmark_decontamination", "op4_sharding", "op13_fill_in_middle"])
def test_no_cross_joins(spark, name):
    plan = QUERIES[name](prepare(spark), FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_native_operator_stays_in_the_jvm(spark):
    plan = QUERIES["op3_benchmark_decontamination"](prepare(spark), FOLDER)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow"):
        assert word not in plan


def test_fill_in_middle_never_shuffles(spark):
    plan = QUERIES["op13_fill_in_middle"](prepare(spark), FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1
