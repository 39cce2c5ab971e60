"""Every registered query against its SQL, and the shape of its plan."""

import os

import pytest

import __spark_entry__
from __spark_entry__ import entry
from compare import compare, connect
from tablesync.plans.oracles import ORACLES
from tablesync.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def database():
    return connect(SF)


def queries():
    """The library's own queries; those of the training-data operators have their tests beside them."""
    return QUERIES


def oracle_sql():
    return ORACLES


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_each_query_has_sql():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(__spark_entry__.queries()) and set(oracle_sql()) <= set(__spark_entry__.oracle_sql())


def test_own_queries_stand_without_the_training_data_operators(monkeypatch):
    import sys

    monkeypatch.setitem(sys.modules, "tablesync.llm", None)
    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    for name in [n for n in sys.modules if n.startswith("tablesync.llm.")]:
        monkeypatch.delitem(sys.modules, name)
    assert set(__spark_entry__.queries()) == set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, database, name):
    assert compare(spark, database, SF, queries()[name], oracle_sql()[name]) is None


# Only the codec of whole bodies needs Python.
@pytest.mark.parametrize("name", sorted(set(queries()) - {"batch_bodies"}))
def test_plan(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"):
        assert node not in plan


def test_entry(spark):
    assert entry(spark).count() > 0


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(queries()["cursor_increment"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan
    plan = plan_of(queries()["op_code_per_record"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan


def test_keys_collapse_before_and_with_one_shuffle(spark):
    plan = plan_of(queries()["cdc_hard_delete"](spark, SF))
    assert plan.count("Exchange") == 1 and "partial_max" in plan
    # Rows are aggregated before they are shuffled.
    assert plan.index("Exchange") < plan.index("partial_max")
    plan = plan_of(queries()["merge_large_batch"](spark, SF))
    assert plan.count("Join") == 0


def test_numbering_uses_no_global_window_over_rows(spark):
    plan = plan_of(queries()["batch_assign"](spark, SF))
    single = plan[plan.index("Exchange SinglePartition") :]
    # What goes to one task is one count per partition.
    assert "HashAggregate(keys=[_part" in single.splitlines()[1]
