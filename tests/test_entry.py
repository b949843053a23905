import importlib.util
import os

import pytest

from conftest import SF_SMALL

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(HERE, "__spark_entry__.py"))
E = importlib.util.module_from_spec(spec)
spec.loader.exec_module(E)

# the library's own queries; the training-data ones are tested in tests/llm
OWN = E.catalog.queries()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "doc_id" in df.columns and "item_id" in df.columns


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.oracle_sql()) and set(OWN) <= set(E.queries())


FORBIDDEN_PLAN_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas",
                        "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_smoke(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.columns == list(dict.fromkeys(df.columns))
    df.limit(5).collect()
    # JVM-side only (no Python UDFs) and no cross joins anywhere in the plan.
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "extended")
    assert not [n for n in FORBIDDEN_PLAN_NODES if n in plan]
