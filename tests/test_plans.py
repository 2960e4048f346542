"""Physical-plan properties that matter at scale."""

import re

import pytest

from tallyspark.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted") \
        if hasattr(df._sc._jvm, "PythonSQLUtils") else plan_text(df)


@pytest.fixture(scope="module")
def plans(spark):
    """The plan of every registered query; each is built once, as file jobs run while they are built."""
    return {name: plan_text(q(spark, SF)) for name, q in QUERIES.items()}


def test_no_python_in_the_plan(plans):
    for name, text in plans.items():
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
            assert node not in text, (name, node)


def test_turnover_date_filter_reaches_the_scan(spark):
    text = formatted(QUERIES["account_turnover"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate,1998-09-15" in text


def test_mirror_merge_is_aggregate_based(spark):
    text = plan_text(QUERIES["mirror_merge"](spark, SF))
    assert "Window" not in text


def test_no_cartesian_or_nested_loop_joins(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


@pytest.mark.parametrize("name,scans", [("mirror_merge", 12), ("versioned_import", 8), ("current_versions", 8)])
def test_inputs_are_read_few_times(spark, name, scans):
    """Scans that run, the derivation of the test inputs included (a shuffle used again is one scan)."""
    df = QUERIES[name](spark, SF)
    df.collect()
    found = re.findall(r"FileScan ", plan_text(df).split("== Initial Plan ==")[0])
    assert len(found) <= scans, len(found)
