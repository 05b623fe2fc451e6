"""Physical-plan shape: no Python UDF, no cartesian product, scans pruned."""

import re

import pytest

from cohortalloc.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_udf_no_cartesian(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"
    # columns no query uses never reach a scan
    for unused in ("l_shipdate", "o_totalprice", "c_acctbal", "c_name", "c_nationkey"):
        assert unused not in plan, f"{name}: scan reads {unused}"


def test_lineitem_scan_is_pruned(spark):
    df = QUERIES["course_subsidy"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in text
    assert "o_totalprice" not in text


def test_course_pipeline_reuses_shared_registration_shuffle(spark):
    # The rate branch and the enrollment-grain branch read the same matched
    # registrations; after execution the final adaptive plan must reuse the
    # registration DISTINCT shuffle instead of running it twice.
    df = QUERIES["course_subsidy"](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    reused = [line for line in final.split("\n") if "ReusedExchange" in line]
    assert any("uniq_combo_id" in line for line in reused), "registration shuffle not reused"


@pytest.mark.parametrize("name", ["degree_subsidy", "doctoral_degree_subsidy", "combined_degree_table"])
def test_no_exchange_on_a_year_or_model_alone(spark, name):
    # even when no table is small enough to be broadcast by size
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the look-up itself is folded by model or year from partial counts; no degree moves by one of them
    alone = re.findall(r"hashpartitioning\((?:matchid|degree_ocurred|ssi_payout_y\d)#\d+L?, \d+\).*\n(.*)", plan)
    assert not [x for x in alone if "stdnt_emplid" in x], alone


@pytest.mark.parametrize("name", ["cohort_weights", "allocated_rates", "doctoral_rates", "course_subsidy"])
def test_no_window_over_fiscal_years(spark, name):
    assert "Window" not in _plan(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["degree_subsidy", "doctoral_degree_subsidy"])
def test_degree_rows_are_shuffled_once_for_all_their_look_ups(spark, name):
    # from the distinct degrees on: one exchange, by model and salt, even if nothing is broadcast by size
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = re.findall(r"Exchange hashpartitioning\((.*?), \d+\).*\n(.*)", plan)
    salted = [keys for keys, _ in moved if "_salt" in keys]
    assert len(salted) == 2, salted  # the degrees, and their small look-up
    after = [keys for keys, rows in moved if "HashAggregate" in rows and "stdnt_emplid" in rows]
    assert len(after) == 1, after


def test_course_rates_are_read_without_a_generator(spark):
    # cohort years are unpivoted and year/basis pairs exploded; the enrollment grain is not
    plan = QUERIES["course_payouts"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "_lk_hit" not in plan
