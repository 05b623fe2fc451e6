"""Golden facts of the two yearly lookup tables."""

import os
import tempfile

from pyspark.sql import functions as F

from cohortalloc.operators.cohorts import fiscal_years_per_year, literal_overlap_factor
from cohortalloc.sources.lookups import (
    PAYOUT_MATRIX_ROWS,
    YEAR_MATRIX_ROWS,
    cohort_years,
    matrix_csv_text,
    read_payout_matrix,
    read_year_matrix,
)
from cohortalloc.sources.schemas import PAYOUT_MATRIX, YEAR_MATRIX


def test_unpivot_has_69_rows_in_matrix_order(spark):
    cy = cohort_years(read_year_matrix(spark))
    assert cy.count() == 69
    row = cy.where("FY = 2013 AND name = 'AY_1'").first()
    assert row.AY == 2012 and row.years_included == "2012,2011,2010"


def test_fiscal_years_fed_per_year(spark):
    counts = {r.acad_year: r.fy_count for r in fiscal_years_per_year(read_year_matrix(spark)).collect()}
    expected = {2010: 1, 2011: 2, 2032: 2, 2033: 1}
    expected.update({y: 3 for y in range(2012, 2018)})
    expected.update({y: 4 for y in (2018, 2019, 2020)})
    expected.update({y: 3 for y in range(2021, 2032)})
    assert counts == expected


def test_derived_factor_equals_literal_list(spark):
    df = fiscal_years_per_year(read_year_matrix(spark)).withColumn(
        "lit", literal_overlap_factor(F.col("acad_year"))
    )
    assert df.where("derived_factor != lit").count() == 0
    assert sorted(r.acad_year for r in df.where("derived_factor < 1").collect()) == [2018, 2019, 2020]


def test_shared_cohort_and_basis_switch():
    by_fy = {r[0]: r for r in YEAR_MATRIX_ROWS}
    assert by_fy[2021][1:4] == by_fy[2022][1:4]
    assert by_fy[2022][5] == "fiscal" and by_fy[2023][5] == "calendar"
    assert [fy for fy, *_ in YEAR_MATRIX_ROWS if by_fy[fy][4] == "complete"] == list(range(2016, 2025))
    gaps = {r[0]: r[4] for r in PAYOUT_MATRIX_ROWS}
    assert gaps[2020] == 1 and gaps[2021] == 2


def test_csv_readers_round_trip_with_bom(spark):
    d = tempfile.mkdtemp(prefix="lookups-")
    ym, pm = os.path.join(d, "years.csv"), os.path.join(d, "payouts.csv")
    with open(ym, "w", encoding="utf-8") as f:
        f.write(matrix_csv_text(YEAR_MATRIX_ROWS, YEAR_MATRIX))
    with open(pm, "w", encoding="utf-8") as f:
        f.write(matrix_csv_text(PAYOUT_MATRIX_ROWS, PAYOUT_MATRIX, bom=True))
    assert sorted(tuple(r) for r in read_year_matrix(spark, ym).collect()) == sorted(YEAR_MATRIX_ROWS)
    got = read_payout_matrix(spark, pm)
    assert got.columns[0] == "year"
    assert sorted(tuple(r) for r in got.collect()) == sorted(PAYOUT_MATRIX_ROWS)


def test_large_lookup_csv_is_read_whole(spark):
    d = tempfile.mkdtemp(prefix="lookups-big-")
    path = os.path.join(d, "years.csv")
    rows = [(2000 + i, 1, 1, 1, "complete", "fiscal", 1) for i in range(1500)]
    with open(path, "w", encoding="utf-8") as f:
        f.write(matrix_csv_text(rows, YEAR_MATRIX))
    assert read_year_matrix(spark, path).count() == 1500


def test_published_values():
    # golden literals, written out here and nowhere derived from the package
    years = {r[0]: r[1:4] for r in YEAR_MATRIX_ROWS}
    assert years[2013] == (2012, 2011, 2010) and years[2022] == (2020, 2019, 2018) and years[2035] == (2033, 2032, 2031)
    assert len(years) == 23
    payouts = {r[0]: r[1:4] for r in PAYOUT_MATRIX_ROWS}
    assert payouts[2013] == (2014, 2015, 2016) and payouts[2020] == (2021, 2022, 2023)
    assert payouts[2021] == (2023, 2024, 2025) and payouts[2030] == (2032, 2033, 2034)
    assert len(payouts) == 18
