"""Yearly refresh, metrics observed while writing, queries given as SQL text."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortalloc.operators import metrics
from cohortalloc.plans import refresh
from cohortalloc.plans.pipelines import Allocation
from cohortalloc.plans.run import run
from cohortalloc.sources.fixtures import FixtureViews
from cohortalloc.sources.sql_text import run_sql, run_sql_file, sql_text

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def files(path):
    return {
        os.path.relpath(os.path.join(d, f), path): os.path.getmtime(os.path.join(d, f))
        for d, _, names in os.walk(path) for f in names if f.startswith("part-")
    }


# --- refresh --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def matched(spark):
    alloc = Allocation(FixtureViews(spark, SF), "INST")
    alloc.keep("match_outcomes")
    return alloc


def test_one_changed_year_rewrites_its_partitions_only(spark, matched):
    path = os.path.join(tempfile.mkdtemp(prefix="hours-"), "hours")
    matrix, all_rows = matched.src.year_matrix, matched.matched
    # one academic year's registrations lose some rows; they lie in two calendar years
    year = 2019
    old = all_rows.where(~((F.col("time_academic_yr") == year) & (F.col("class_number") < "200")))
    refresh.store_hours(old, matrix, path)
    before = files(path)
    calendar = [r[0] for r in all_rows.where(F.col("time_academic_yr") == year).select("calendar_year").distinct().collect()]
    years = sorted({year, *calendar})
    assert refresh.refresh_hours(all_rows, matrix, path, years) == []
    after = files(path)
    kept = {f for f in before if before[f] == after.get(f)}
    touched = {os.path.dirname(f) for f in {*before, *after} - kept}
    assert touched and touched <= {f"aggr_basis={b}/year={y}" for b in ("fiscal", "calendar") for y in years}
    assert len(kept) > len(before) / 2
    whole = Allocation(matched.src, "INST")
    again = Allocation(matched.src, "INST", hours=refresh.read_hours(spark, path, matched.year_type_hours.schema))
    assert rows(again.year_type_hours) == rows(whole.year_type_hours)
    assert rows(again.rate_by_acad_year) == rows(whole.rate_by_acad_year)


def test_a_year_without_registrations_loses_its_partition(spark, matched):
    path = os.path.join(tempfile.mkdtemp(prefix="hours-"), "hours")
    refresh.store_hours(matched.matched, matched.src.year_matrix, path)
    none_left = matched.matched.where("time_academic_yr != 2018 and calendar_year != 2018")
    assert "aggr_basis=fiscal/year=2018" in refresh.refresh_hours(none_left, matched.src.year_matrix, path, [2018])
    held = refresh.read_hours(spark, path, matched.year_type_hours.schema)
    assert held.where("year = 2018").count() == 0 and held.count() > 0


# --- metrics ----------------------------------------------------------------------------


def jobs(spark, group, work):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        work()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_metrics_equal_the_aggregates_and_need_no_pass(spark):
    alloc = Allocation(FixtureViews(spark, SF), "INST")
    alloc.keep("degree_subsidy")
    frame, seen = metrics.observe(alloc.degree_subsidy, "degree_subsidy")
    folder = tempfile.mkdtemp(prefix="metrics-")
    plain = jobs(spark, "plain", lambda: alloc.degree_subsidy.write.parquet(f"{folder}/plain"))
    watched = jobs(spark, "watched", lambda: frame.write.parquet(f"{folder}/watched"))
    assert watched == plain
    found = seen.get
    assert found["n_rows"] == alloc.degree_subsidy.count()
    want = alloc.degree_subsidy.agg(F.min("total_all_three_years_ssi_per_degree"), F.count("total_all_three_years_ssi_per_degree")).first()
    assert (found["min_total_all_three_years_ssi_per_degree"], found["known_total_all_three_years_ssi_per_degree"]) == tuple(want)
    assert rows(metrics.flag_frame(spark, found, alloc.degree_subsidy)) == rows(alloc.degree_flag_check)
    alloc.forget()


def test_a_run_answers_flag_checks_from_its_metrics(spark):
    alloc = Allocation(FixtureViews(spark, SF), "INST")
    root = tempfile.mkdtemp(prefix="run-")
    outputs = ("degree_subsidy", "degree_flag_check", "run_metrics")
    written = run(spark, alloc, root, outputs=outputs)
    assert rows(spark.read.parquet(written["degree_flag_check"])) == rows(alloc.degree_flag_check)
    found = {r.metric: r.value for r in spark.read.parquet(written["run_metrics"]).collect()}
    assert found["n_rows"] == alloc.degree_subsidy.count()
    # asked for alone, the check reads the degrees
    alone = run(spark, alloc, root, outputs=("degree_flag_check",))
    assert rows(spark.read.parquet(alone["degree_flag_check"])) == rows(alloc.degree_flag_check)
    alloc.forget()


# --- SQL text ------------------------------------------------------------------------------


def test_sql_files_equal_their_frames(spark):
    alloc = Allocation(FixtureViews(spark, SF), "INST")
    sources = {n: getattr(alloc.src, n) for n in ("course_allocations", "enrollments", "term_lookup")}
    got = run_sql(spark, sql_text("course_dollars"), sources, {"institution": "INST"}, alloc.dollars.schema)
    assert rows(got) == rows(alloc.dollars)
    got = run_sql(spark, sql_text("class_number_lengths"), sources, {"eligible": 1, "completed": 1})
    assert rows(got) == rows(alloc.class_number_lengths)


def test_sql_parameters_are_values_and_results_are_declared(spark):
    people = spark.createDataFrame([(1, "a' OR 'x'='x"), (2, "{b}")], "id int, name string")
    path = os.path.join(tempfile.mkdtemp(prefix="sql-"), "q.sql")
    with open(path, "w") as f:
        f.write("-- names with {braces}\nSELECT name, id FROM people WHERE name = :who -- the end\n")
    schema = StructType.fromDDL("id int, name string")
    find = lambda who, s=schema: run_sql_file(spark, path, {"people": people}, {"who": who}, s)
    assert [tuple(r) for r in find("a' OR 'x'='x").collect()] == [(1, "a' OR 'x'='x")]
    assert find("a").count() == 0 and find("{b}").count() == 1
    with pytest.raises(ValueError, match="id"):
        find("a", StructType.fromDDL("id bigint, name string"))
    with pytest.raises(ValueError, match="name"):
        find("a", StructType.fromDDL("id int"))
    assert not [t for t in spark.catalog.listTables() if t.name == "people"]
