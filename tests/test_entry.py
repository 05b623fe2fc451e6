"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_with_stable_schema(spark):
    mod = _entry_module()
    df = mod.entry(spark)
    assert df.columns[:3] == ["newid", "class_course", "cumul_total_cr_hours"]
    assert "ssi_per_course_per_cr_hours" in df.columns
    assert df.count() > 0


def test_queries_and_oracles_agree():
    mod = _entry_module()
    q, o = mod.queries(), mod.oracle_sql()
    from cohortalloc.plans.catalog import QUERIES
    from cohortalloc.plans.oracle import ORACLE_SQL

    assert len(QUERIES) == 67
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(q) and set(o) <= set(q)
    assert all(callable(f) for f in q.values())
