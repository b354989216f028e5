"""Every registered query against its SQL, and what its plan must not contain."""

from __future__ import annotations

import pandas as pd
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from costgauge.workload import QUERIES as ALL
from costgauge.workload import SQL, services



@pytest.fixture(scope="module")
def connection(tiny):
    return check.duck(tiny)


def test_every_query_has_sql():
    assert set(SQL) == set(ALL)
    assert set(ALL) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", ALL)
def test_query_equals_sql(spark, tiny, connection, name):
    frame = ALL[name](spark, tiny)
    got = pd.DataFrame([tuple(row) for row in frame.collect()], columns=frame.columns, dtype=object)
    found = connection.execute(SQL[name])
    wanted = pd.DataFrame(found.fetchall(), columns=[d[0] for d in found.description], dtype=object)
    assert check.differences(got, wanted) is None
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEvalPython", "MapInPandas"):
        assert operator not in plan


def test_entry(spark):
    assert len(entry(spark).collect()) > 0


def test_filters_and_columns_reach_the_scan(spark, tiny):
    plan = ALL["parent_inherit"](spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "l_extendedprice" not in plan
    assert "WindowGroupLimit" in ALL["upsert_latest"](spark, tiny)._jdf.queryExecution().executedPlan().toString()
    upsert = ALL["upsert_latest"](spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,A)" in upsert


def test_portfolio_reads_shared_aggregates_once(spark, tiny):
    """Both rules of a service read its stored rows, and not each the shuffled samples."""
    plan = services.portfolio(spark, tiny)._jdf.queryExecution().optimizedPlan().toString()
    used = [line for line in plan.split("\n") if "Relation [" not in line]
    assert not any("l_tax" in line or "o_totalprice" in line for line in used)
