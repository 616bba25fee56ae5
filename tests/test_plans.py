"""Physical plans of every registered query: no cross join, no nested-loop
join, no Python code or Python-side data in the data path, and service-type
filters reach the published folders."""

import os

import pytest

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF", "ExistingRDD", "RoundRobinPartitioning")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    from waitlens.sources.catalog import Tables, publish
    path = str(tmp_path_factory.mktemp("published"))
    publish(Tables.from_driver(spark, SF, staging=path + "_staging"), path)
    return path


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_no_cross_join_or_python_in_any_query(spark, published):
    from waitlens.registry import PLANS, TEST, Context
    from waitlens.sources.catalog import Tables
    ctx = Context(Tables.from_dir(spark, published), TEST)
    bad = {}
    for name, plan in PLANS.items():
        text = plan_text(plan(ctx))
        hits = [f for f in FORBIDDEN if f in text]
        if hits:
            bad[name] = hits
    assert not bad, bad


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_service_filter_prunes_folders(spark, published):
    from waitlens.registry import PLANS, TEST, Context
    from waitlens.sources.catalog import Tables
    ctx = Context(Tables.from_dir(spark, published), TEST)
    text = plan_text(PLANS["np_rate"](ctx))
    assert "PartitionFilters: [isnotnull(tipo_prest" in text and "(tipo_prest#" in text
    assert "PushedFilters: [IsNotNull(f_salida), GreaterThanOrEqual(f_salida" in text
