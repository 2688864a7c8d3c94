"""The view over the test tables that all workload queries start from."""

from __future__ import annotations

from workload.bronze_view import event_lines

SF_DIR = "/root/testdata/sf0.001"


def test_product_columns_are_made_before_the_join(spark):
    """Once per product, not once per event; and no array function runs row by row outside generated code."""
    plan = event_lines(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first_join = next(i for i, line in enumerate(plan) if "Join LeftOuter" in line)
    assert [i for i, line in enumerate(plan) if "lower(" in line and i < first_join] == []
    assert any("lower(" in line for line in plan)
    assert not any("lambda" in line for line in plan)
