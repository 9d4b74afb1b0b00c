"""Every registered query against its oracle, and what its plan must not hold."""

import pytest

import oracle
from spillway.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = oracle.connect(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    cols, _, rows = oracle.spark_rows(df)
    if name not in ORACLES:
        assert rows
        return
    want_cols, types, want = oracle.duck_rows(duck, ORACLES[name])
    assert cols == want_cols
    assert rows == want
    assert not [c for c, t in types.items() if "HUGEINT" in t or "DECIMAL" in t]


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert len(ORACLES) >= len(QUERIES) - 1
