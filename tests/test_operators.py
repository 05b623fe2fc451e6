"""Hand-sized cases for the frame operators."""

import pytest
from pyspark.sql import functions as F

from cohortalloc.operators import audit, cohorts, degrees, payouts
from cohortalloc.sources.lookups import read_payout_matrix, read_year_matrix


def test_cohort_weight_and_rate(spark):
    # one model, two courses with 30 and 10 credit hours feeding FY 2020; 800 dollars
    hours = spark.createDataFrame(
        [(2019, "M1", "C1", 3, 10, 30, "fiscal"), (2018, "M1", "C2", 1, 10, 10, "fiscal")],
        "year int, newid string, class_course string, credit_hours int, "
        "n_students_per_class long, total_credit_hr_per_class long, aggr_basis string",
    )
    ym = read_year_matrix(spark).where("FY = 2020")
    w = cohorts.cohort_weights(hours, ym)
    weights = {r.class_course: r.credit_hours_weight for r in w.collect()}
    assert weights == {"C1": 0.75, "C2": 0.25}
    dollars = spark.createDataFrame(
        [("X", "M1", 2020, 800.0)],
        "inst_code string, newid string, fiscal_year_ssi_recognized int, ssi_total_amount double",
    )
    rates = [r.ssi_per_course_per_cr_hours for r in cohorts.allocated_rates(w, dollars).collect()]
    assert rates == [20.0, 20.0]


def test_null_model_ids_form_their_own_cohort(spark):
    hours = spark.createDataFrame(
        [(2019, None, "C1", 1, 2, 2, "fiscal"), (2019, None, "C2", 1, 6, 6, "fiscal")],
        "year int, newid string, class_course string, credit_hours int, "
        "n_students_per_class long, total_credit_hr_per_class long, aggr_basis string",
    )
    w = cohorts.cohort_weights(hours, read_year_matrix(spark).where("FY = 2020"))
    assert sorted(r.grand_total_cr_hours for r in w.collect()) == [8, 8]


def test_overlap_factor_literal(spark):
    rates = spark.createDataFrame(
        [("M", "C", 2018, fy, 1.0) for fy in (2019, 2020, 2021, 2022)]
        + [("M", "C", 2017, fy, 1.0) for fy in (2018, 2019, 2020)],
        "newid string, class_course string, acad_year int, fiscal_year int, ssi_per_course_per_cr_hours double",
    )
    got = {r.acad_year: r.adj_total_ssi for r in cohorts.rate_by_acad_year(rates).collect()}
    assert got == {2018: 3.0, 2017: 3.0}
    derived = cohorts.rate_by_acad_year(rates, read_year_matrix(spark), overlap="derived")
    assert {r.acad_year: r.adj_total_ssi for r in derived.collect()} == got


def test_completeness_of_payout_years(spark):
    rows = spark.createDataFrame(
        [(1, 2016, 2017, 2018), (2, 2023, 2024, 2025), (3, 2034, 2035, 2036)],
        "id int, ssi_payout_y1 int, ssi_payout_y2 int, ssi_payout_y3 int",
    )
    out = payouts.attach_status(rows, read_year_matrix(spark))
    flags = {r.id: r.complete_flag for r in out.collect()}
    assert flags == {1: "complete", 2: "incomplete", 3: "incomplete"}


def test_payout_years_drop_rows_outside_matrix(spark):
    rows = spark.createDataFrame([(1, 2012), (2, 2020), (3, 2021)], "id int, time_academic_yr int")
    out = {r.id: (r.ssi_payout_y1, r.ssi_payout_y3) for r in payouts.add_payout_years(rows, read_payout_matrix(spark)).collect()}
    assert out == {2: (2021, 2023), 3: (2023, 2025)}


def test_attach_by_year_reads_three_years_in_one_join(spark):
    rows = spark.createDataFrame(
        [(1, "M", "C", 2019, 2020, 2021), (2, None, "C", 2019, 2020, 2021), (3, "Z", "C", 2019, 2020, 2021)],
        "id int, newid string, class_course string, ssi_payout_y1 int, ssi_payout_y2 int, ssi_payout_y3 int",
    )
    rates = spark.createDataFrame(
        [("M", "C", 2019, 1.5), ("M", "C", 2021, 2.5), (None, "C", 2020, 9.0)],
        "newid string, class_course string, acad_year int, adj_total_ssi double",
    )
    out = payouts.attach_course_payouts(rows, rates)
    got = {r.id: (r.ssi_y1_payout_total_ssi, r.ssi_y2_payout_total_ssi, r.ssi_y3_payout_total_ssi) for r in out.collect()}
    assert got == {1: (1.5, None, 2.5), 2: (None, 9.0, None), 3: (None, None, None)}


def test_attach_by_year_fans_out_on_two_values(spark):
    rows = spark.createDataFrame([(1, "C", 2020, 2021), (2, "D", 2020, 2021)], "id int, class_course string, y1 int, y2 int")
    rates = spark.createDataFrame(
        [("C", 2020, 1.0), ("C", 2020, 2.0), ("C", 2021, 5.0), ("D", 2020, None), ("D", None, 9.0)],
        "class_course string, fiscal_year int, v double",
    )
    got = payouts.attach_by_year(rows, rates, ["class_course"], "fiscal_year", "v", {"a": "y1", "b": "y2"})
    assert sorted((r.id, r.a, r.b) for r in got.where("id = 1").collect()) == [(1, 1.0, 5.0), (1, 2.0, 5.0)]
    assert [(r.id, r.a, r.b) for r in got.where("id = 2").collect()] == [(2, None, None)]


def test_two_doctoral_totals_in_one_year_give_two_rates(spark):
    hours = spark.createDataFrame(
        [(2016, "C", 3.0, 2, 6.0)],
        "time_academic_yr int, class_course string, credit_hours double, n_students_per_class long, total_credit_hr_per_class double",
    )
    totals = spark.createDataFrame([(2017, 60.0), (2017, 120.0)], "ssi_payout_y1 int, ssi_y1_payout_total_amount double")
    got = cohorts.doctoral_rates(hours, read_year_matrix(spark).where("FY = 2017"), totals)
    assert sorted(r.ssi_per_course_per_cr_hours for r in got.collect()) == [10.0, 20.0]


def test_degree_average_and_flag(spark):
    rows = spark.createDataFrame(
        [("M1", 2016, 2017, 2018, 3, 3, 3, 100.0, 50.0, 25.0)],
        "matchid string, ssi_payout_y1 int, ssi_payout_y2 int, ssi_payout_y3 int, "
        "ssi_payout_y1_total_degree long, ssi_payout_y2_total_degree long, ssi_payout_y3_total_degree long, "
        "ssi_y1_payout_total_amount double, ssi_y2_payout_total_amount double, ssi_y3_payout_total_amount double",
    )
    avg = degrees.average_per_degree(rows).first()
    assert (avg.ssi_payout_avg_y1_per_degree, avg.ssi_payout_avg_y2_per_degree, avg.ssi_payout_avg_y3_per_degree) == (33.3, 16.7, 8.3)
    assert round(avg.total_all_three_years_ssi_per_degree, 6) == 58.3


def test_set_difference_is_null_safe(spark):
    a = spark.createDataFrame([("a",), ("b",), (None,)], "newid string")
    b = spark.createDataFrame([("b",), (None,)], "newid string")
    only_a, only_b = audit.model_id_set_difference(a, b)
    assert [r.newid for r in only_a.collect()] == ["a"]
    assert only_b.count() == 0


def test_latest_inventory_keeps_ineligible_row_at_max_version(spark):
    inv = spark.createDataFrame(
        [
            (20191, 1, "S", "1", "AH", "0", "1", "Y"),
            (20191, 2, "S", "1", "AH", "0", "2", "Y"),
            (20191, 2, "S", "1", "AH", "0", "3", "N"),
            (20191, 3, "S", "1", "AH", "0", "4", "N"),
            (None, 1, "T", "1", "AH", "0", "1", "Y"),
        ],
        "strm int, strm_version long, crse_subject string, crse_catalog_nbr string, "
        "hei_subsidy_model_subj string, hei_course_level string, hei_subsidy_model_code string, "
        "hei_subsidy_eligible string",
    )
    got = sorted(r.newid for r in audit.latest_inventory(inv).collect())
    assert got == ["AH02", "AH03"]
