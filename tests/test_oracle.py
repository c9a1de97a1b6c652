"""Every registered query against its oracle SQL, on the smallest tables."""

import sys

import pytest
from compare import compare, oracle_connection

from bindings.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return oracle_connection(sf)


BAD = ("EvalPython", "InPandas", "InArrow", "BroadcastNestedLoopJoin", "CartesianProduct")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def eager_plans(monkeypatch):
    """Plans of the tables that a query writes or checkpoints on its way."""
    plans = []

    def watched(make):
        def run(df, *args, **kwargs):
            plans.append(plan(df))
            return make(df, *args, **kwargs)

        return run

    for name, module in list(sys.modules.items()):
        if name.split(".")[0] in ("hammerline", "bindings"):
            for function in ("write_table", "materialise"):
                if hasattr(module, function):
                    monkeypatch.setattr(module, function, watched(getattr(module, function)))
    return plans


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle_without_python_or_cross_joins(spark, sf, con, eager_plans, name):
    result = QUERIES[name](spark, sf)
    problems, _ = compare(result, con, ORACLES[name])
    assert not problems, "\n".join(problems)
    for text in [*eager_plans, plan(result)]:
        assert not any(x in text for x in BAD)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
