"""Every registered query against its SQL."""

import re

import pytest

import __spark_entry__ as registered
from casegraph.operators import model as mo
from casegraph.operators import training as tr
from oracle import connect, difference
from workload import case_queries
from workload.tables import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql_engine():
    return connect(SF)


# Queries in which a Python function belongs to the operator.
WITH_PYTHON = {"extract_report", "feature_embedding", "propagate_1hop"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_matches_sql(spark, sql_engine, name):
    result = registered.queries()[name](spark, SF)
    plan = plan_of(result)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert not re.search(r"Window .*\n.*(Sort.*\n.*)?Exchange SinglePartition", plan)
    neighbours = re.search("MapInPandas|CoGroupInPandas", plan) is not None
    assert neighbours or name in WITH_PYTHON or not re.search("EvalPython", plan)
    expected = sql_engine.execute(registered.oracle_sql()[name]).df()
    assert difference(result.toPandas(), expected) is None


def test_every_sql_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def test_model_report(spark):
    """The run on all 13 features and their neighbourhoods is iterative and has no SQL counterpart."""
    evaluated = case_queries.evaluated(Tables(spark, SF))
    values = {r["metric"]: r["value"] for r in evaluated.report.collect()}
    assert evaluated.predictions.where("prob BETWEEN 0 AND 1").count() == evaluated.predictions.count() > 0
    assert set(values) == {"auc", "f1", "precision", "recall"}
    assert 0.0 <= values["f1"] <= 1.0


def test_training_reads_the_order_lines_of_admissions_once(spark, monkeypatch):
    plans = {}

    def seen(rows, name):
        plans[name] = rows._jdf.queryExecution().optimizedPlan().toString()
        return materialize(rows, name)

    materialize = case_queries.materialize
    monkeypatch.setattr(case_queries, "materialize", seen)
    case_queries.epoch_training(Tables(spark, SF))
    assert "min(l_returnflag" in plans["admissions"] and "min(l_returnflag" not in plans["training-features"]


def test_mortality_model_trains_for_all_epochs(spark, monkeypatch):
    schedules = []

    def seen(training, validation, schedule):
        schedules.append(schedule)
        return tr.Trained(mo.LinearModel((), 0.0), 0, None, [])

    monkeypatch.setattr(tr, "train_epochs", seen)
    assert registered.queries()["mortality_model"](spark, SF).count() == 0
    assert schedules == [tr.Schedule()] and (schedules[0].epochs, schedules[0].learning_rate, schedules[0].every) == (300, 1e-3, 10)
