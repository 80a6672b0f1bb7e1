"""Physical plans that must not regress."""

import pytest

import __spark_entry__ as entry_module

FOLDER = "/root/testdata/sf0.001"


def _plan(spark, name):
    df = entry_module.queries()[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


def test_comparison_shuffles_each_side_once(spark):
    plan = _plan(spark, "diff_price")
    assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    # Two limits per side: before and after the shuffle.
    assert plan.count("WindowGroupLimit") == 4


@pytest.mark.parametrize("name", ["diff_color", "history_cap10", "price_lag_changes", "table_compare",
                                  "bracket_pricing", "translate_cells", "page_links"])
def test_no_cartesian_product_and_no_python(spark, name):
    plan = _plan(spark, name)
    for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_history_reads_only_its_columns(spark):
    plan = _plan(spark, "history_cap10")
    assert "props" not in plan.split("ReadSchema")[1]
