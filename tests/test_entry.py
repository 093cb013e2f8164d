import os
import re

import pytest

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"


def own_queries():
    """Without those of the training-data operators, which tests/llm covers."""
    return {k: v for k, v in E.queries().items() if not re.match(r"op\d+_|pipeline$", k)}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "ret" in df.columns and df.count() > 0


def test_every_query_has_an_oracle_or_reason():
    assert set(E.oracle_sql()) <= set(E.queries())
    qs, orc = own_queries(), E.oracle_sql()
    assert len(qs) >= 70
    assert set(qs) - set(orc) == set()


@pytest.mark.skipif(not os.path.exists(SMOKE), reason="no smoke data")
def test_registered_queries_run_on_smoke_data(spark):
    bad = []
    for name, fn in own_queries().items():
        if name.startswith("stream_"):
            continue
        try:
            fn(spark, SMOKE).limit(1).collect()
        except Exception as e:  # noqa: BLE001
            bad.append((name, str(e)[:200]))
    assert bad == []


@pytest.mark.skipif(not os.path.exists(SMOKE), reason="no smoke data")
def test_no_cross_or_nested_loop_joins(spark):
    """No registered query plans a cartesian product or a nested-loop join."""
    found = {}
    for name, fn in own_queries().items():
        if name.startswith("stream_"):
            continue
        plan = fn(spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
        hits = [p for p in ("CartesianProduct", "BroadcastNestedLoopJoin") if p in plan]
        if hits:
            found[name] = hits
    assert found == {}
