"""The plans of the corpus queries, as `tests/test_plans.py` holds those of the core."""

import pytest

from vigil.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op3_license_scan", "op9_line_dedup"}))
def test_no_cross_or_loop_joins(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    assert "SinglePartition" not in plan


def test_every_level_of_the_manifest_joins_by_key(spark, monkeypatch):
    from vigil.llm import merkle

    plans = []
    write = merkle.materialize

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(merkle, "materialize", seen)
    QUERIES["op11_merkle"](spark, SF).count()
    assert any(name.startswith("attached") for name, _ in plans)
    assert not [name for name, plan in plans if "NestedLoop" in plan or "Cartesian" in plan or "SinglePartition" in plan]
