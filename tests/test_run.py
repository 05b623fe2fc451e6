"""End-to-end run: fixture tables written as parquet, read back by the
production reader, all outputs written through the sinks."""

import os
import tempfile

from cohortalloc.plans.pipelines import Allocation
from cohortalloc.plans.run import run
from cohortalloc.sinks.publish import read_published
from cohortalloc.sources.fixtures import FixtureViews
from cohortalloc.sources.readers import load_tables
from cohortalloc.sources.schemas import SOURCES

SF = "/root/testdata/sf0.001"


def test_run_writes_every_output(spark):
    root = tempfile.mkdtemp(prefix="run-")
    views = FixtureViews(spark, SF)
    for name in SOURCES:
        getattr(views, name).write.mode("overwrite").parquet(os.path.join(root, "tables", name))
    sources = load_tables(spark, os.path.join(root, "tables"))
    alloc = Allocation(sources, "INST")
    written = run(spark, alloc, os.path.join(root, "out"))
    assert set(written) >= {"course_subsidy", "combined_course_table", "combined_degree_table"}
    course = spark.read.parquet(written["course_subsidy"])
    assert course.count() == alloc.course_subsidy.count() > 0
    assert len(course.columns) == 23
    for name in ("combined_course_table", "combined_degree_table"):
        got, want = read_published(spark, written[name]), getattr(alloc, name)
        assert sorted(got.columns) == sorted(want.columns)
        keys = [c for c in want.columns if dict(want.dtypes)[c] != "double"]
        assert sorted(map(str, got.select(*keys).collect())) == sorted(map(str, want.select(*keys).collect()))
    # the match join ran once: every course output starts from the kept outcomes
    for name in ("course_subsidy", "doctoral_subsidy", "allocated_rates", "model_id_discrepancies"):
        plan = getattr(alloc, name)._jdf.queryExecution().optimizedPlan().toString()
        assert "class_nbr" not in plan, name
    again = run(spark, alloc, os.path.join(root, "out"), outputs=("combined_degree_table",))
    assert read_published(spark, again["combined_degree_table"]).count() == alloc.combined_degree_table.count()
    exported = run(spark, alloc, os.path.join(root, "csv"), fmt="csv", outputs=("combined_degree_table",))
    assert spark.read.csv(exported["combined_degree_table"], header=True).count() == alloc.combined_degree_table.count()
    alloc.forget()


def test_run_loads_named_tables(spark):
    views = FixtureViews(spark, SF)
    spark.sql("CREATE DATABASE IF NOT EXISTS run_outputs")
    alloc = Allocation(views, "INST", own_unmatched=True)
    outputs = ("degree_subsidy", "combined_degree_table", "unmatched_breakdown")
    for _ in range(2):  # a repeated run replaces its rows
        written = run(spark, alloc, None, outputs=outputs, database="run_outputs")
    assert written["combined_degree_table"] == "run_outputs.combined_degree_table"
    table = spark.table("run_outputs.combined_degree_table")
    assert {r["source"]: r["count"] for r in table.groupBy("source").count().collect()} == {
        r["source"]: r["count"] for r in alloc.combined_degree_table.groupBy("source").count().collect()}
    assert spark.table("run_outputs.degree_subsidy").count() == alloc.degree_subsidy.count()
    alloc.forget()
    spark.sql("DROP DATABASE run_outputs CASCADE")


def test_run_needs_a_shared_checkpoint_folder(spark, monkeypatch):
    import pytest

    from cohortalloc.plans import run as module

    monkeypatch.setattr(module, "configured_checkpoint_dir", lambda spark: None)
    with pytest.raises(ValueError, match="checkpoint"):
        run(spark, Allocation(FixtureViews(spark, SF), "INST"), "/nowhere")
