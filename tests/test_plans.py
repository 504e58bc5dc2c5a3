"""Plan guards: no cartesian products and no nested-loop joins."""

from conftest import SF_SMALL
from ragtide.plans import catalog


def test_no_cartesian_products(spark):
    bad = []
    for key, fn in sorted(catalog.queries().items()):
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        if "CartesianProduct" in plan:
            bad.append((key, "CartesianProduct"))
        if "BroadcastNestedLoopJoin" in plan:
            bad.append((key, "BroadcastNestedLoopJoin"))
    assert not bad, bad
