"""Property tests: the Spark operators against brute-force formulations."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortalloc.operators import cohorts, payouts
from cohortalloc.sources.lookups import YEAR_MATRIX_ROWS, read_year_matrix

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

models = st.sampled_from(["M1", "M2", None])
courses = st.sampled_from(["C1", "C2"])
years = st.integers(min_value=2016, max_value=2024)


@SETTINGS
@given(
    rows=st.lists(st.tuples(models, courses, years), min_size=1, max_size=12),
    rates=st.dictionaries(st.tuples(models, courses, years), st.floats(0, 100, allow_nan=False), max_size=15),
)
def test_attach_by_year_equals_three_left_joins(spark, rows, rates):
    df = spark.createDataFrame(
        [(i, m, c, y, y + 1, y + 2) for i, (m, c, y) in enumerate(rows)],
        "id int, newid string, class_course string, ssi_payout_y1 int, ssi_payout_y2 int, ssi_payout_y3 int",
    )
    table = spark.createDataFrame(
        [(m, c, y, v) for (m, c, y), v in rates.items()] or [("x", "x", 0, 0.0)],
        "newid string, class_course string, acad_year int, adj_total_ssi double",
    )
    got = {r.id: (r.ssi_y1_payout_total_ssi, r.ssi_y2_payout_total_ssi, r.ssi_y3_payout_total_ssi)
           for r in payouts.attach_course_payouts(df, table).collect()}
    expected = {i: tuple(rates.get((m, c, y + k)) for k in range(3)) for i, (m, c, y) in enumerate(rows)}
    assert got == expected


def _loop_weights(hours: pd.DataFrame) -> dict:
    """Per-FY loop over the matrix, as the published rule is written."""
    out = {}
    for fy, *ays, _status, basis, _gap in YEAR_MATRIX_ROWS:
        sub = hours[hours.year.isin(ays) & (hours.aggr_basis == basis)]
        if sub.empty:
            continue
        cum = sub.groupby(["year", "newid", "class_course"], dropna=False).total.sum().reset_index()
        grand = cum.groupby("newid", dropna=False).total.transform("sum")
        for (y, m, c, t), g in zip(cum[["year", "newid", "class_course", "total"]].itertuples(index=False), grand):
            out[(fy, y, None if pd.isna(m) else m, c)] = (int(t), int(g))
    return out


@SETTINGS
@given(
    rows=st.lists(
        st.tuples(st.integers(2015, 2023), models, courses, st.integers(1, 4), st.sampled_from(["fiscal", "calendar"])),
        min_size=1,
        max_size=15,
    )
)
def test_cohort_weights_equal_per_year_loop(spark, rows):
    hours = spark.createDataFrame(
        [(y, m, c, h, 1, h, b) for y, m, c, h, b in rows],
        "year int, newid string, class_course string, credit_hours int, "
        "n_students_per_class long, total_credit_hr_per_class long, aggr_basis string",
    ).groupBy("year", "newid", "class_course", "credit_hours", "aggr_basis").sum(
        "n_students_per_class", "total_credit_hr_per_class"
    ).withColumnRenamed("sum(n_students_per_class)", "n_students_per_class").withColumnRenamed(
        "sum(total_credit_hr_per_class)", "total_credit_hr_per_class"
    )
    got = {
        (r.fiscal_year, r.acad_year, r.newid, r.class_course): (r.cumul_total_cr_hours, r.grand_total_cr_hours)
        for r in cohorts.cohort_weights(hours, read_year_matrix(spark)).collect()
    }
    pdf = pd.DataFrame(rows, columns=["year", "newid", "class_course", "total", "aggr_basis"])
    assert got == _loop_weights(pdf)
