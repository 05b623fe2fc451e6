"""The match join: one for all outputs, without a shuffle on stored facts, hot keys spread."""

import re

import pytest
from pyspark.sql import functions as F

from cohortalloc.operators import registration
from cohortalloc.plans.pipelines import Allocation
from cohortalloc.sinks.buckets import salted_facts, store_match_facts
from cohortalloc.sources.fixtures import FixtureViews

SF = "/root/testdata/sf0.001"
COLUMNS = [c for c in registration.REGISTRATION_COLUMNS]


def facts(spark, registrations, enrollments):
    """Passed registrations (number, term, student) and eligible enrollments (number, term, student, flag)."""
    passed = spark.createDataFrame(registrations, "new_class_number string, time_strm int, campus_id string")
    extra = {c: F.lit(None).cast("string") for c in COLUMNS if c not in passed.columns}
    extra["uniq_combo_id"] = F.concat_ws("-", "new_class_number", "time_strm", "campus_id")
    passed = passed.withColumns(extra).select(*COLUMNS)
    eligible = spark.createDataFrame(
        enrollments, "class_nbr string, strm int, student_pid string, completed_flag int"
    ).withColumns({
        "newid": F.lit("DOC1"), "calendar_year": F.lit(2020), "term_code": F.lit("20201F"),
        "subsidy_eligible_code": F.lit(1), "crse_grade_off": F.lit(None).cast("string")})
    return passed, eligible


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def skewed(spark):
    hot = [("00001", 20201, "P1", i) for i in range(300)]  # one key holds most enrollments
    registrations = [("00001", 20201, "P1"), ("00002", 20201, "P2"), ("00003", 20202, "P3"), (None, 20201, "P1"),
                     ("00001", None, "P1"), ("00009", 20209, None)]
    enrollments = hot + [("00002", 20201, "P2", 0), ("00002", 20201, "P2", 0), (None, 20201, "P1", 1), ("00007", 20201, "P2", 1)]
    return facts(spark, registrations, enrollments)


def test_sides_of_the_match(spark, skewed):
    outcomes = registration.match_outcomes(*skewed)
    counts = {r["match_side"]: r["count"] for r in outcomes.groupBy("match_side").count().collect()}
    assert counts == {"matched": 302, "registration only": 4}
    assert {r.newid for r in registration.matched_rows(outcomes).collect()} == {"Doc1"}
    assert registration.unmatched_rows(outcomes).count() == 4
    assert registration.merged_rows(outcomes).count() == 306


@pytest.mark.parametrize("hot_rows", [1, 100, 10_000])
def test_salted_facts_give_the_same_outcomes(spark, skewed, hot_rows):
    passed, eligible = salted_facts(*skewed, hot_rows=hot_rows, salts=8)
    assert rows(registration.match_outcomes(passed, eligible, salted=True)) == rows(registration.match_outcomes(*skewed))
    if hot_rows == 100:
        hot = eligible.where("student_pid = 'P1' and class_nbr is not null").groupBy("_salt").count().collect()
        assert len(hot) == 8 and max(r["count"] for r in hot) < 80


def test_stored_facts_join_without_an_exchange(spark):
    alloc = Allocation(FixtureViews(spark, SF), "INST")
    stored = store_match_facts(spark, alloc.passed, alloc.eligible, "test_facts", buckets=4, hot_rows=3, salts=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = Allocation(FixtureViews(spark, SF), "INST", match_facts=stored, own_unmatched=True)
        for name in ("matched", "merged"):
            plan = getattr(again, name)._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        assert rows(again.matched) == rows(alloc.matched)
        assert rows(again.merged) == rows(alloc.merged)
        assert rows(again.unmatched_breakdown) == rows(alloc.unmatched_breakdown)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("registrations", "enrollments"):
            spark.sql(f"DROP TABLE IF EXISTS test_facts_{name}")


def test_one_join_feeds_every_output_of_a_run(spark):
    alloc = Allocation(FixtureViews(spark, SF), "INST", own_unmatched=True)
    alloc.keep_shared()
    for name in ("course_subsidy", "doctoral_subsidy", "allocated_rates", "merged", "model_id_discrepancies", "unmatched", "match_counts"):
        plan = getattr(alloc, name)._jdf.queryExecution().optimizedPlan().toString()
        assert "student_pid" not in plan and "l_orderkey" not in re.sub(r"(?s)doctoral.*", "", plan) or name == "doctoral_subsidy", name
        assert "class_nbr" not in plan, name
    alloc.forget()
