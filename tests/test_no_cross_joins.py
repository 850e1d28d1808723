"""Scale rule: no registered query plans a cartesian product or a
nested-loop join (every pairing is an equi-join on a key or a grid cell)."""
import pytest

import __spark_entry__ as E

QUERIES = E.queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join(spark, sf, name):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
