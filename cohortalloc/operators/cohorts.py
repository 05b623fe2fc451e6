"""Cohort aggregation: which earlier years' activity each fiscal year pays for.

The year matrix says, for every fiscal year FY, which three years feed it.
Instead of looping over fiscal years, the facts are joined once to the
unpivoted matrix (69 rows, broadcast) and aggregated with FY as a grouping
key.  Grand totals "per FY" or "per (FY, model)" are aggregates of the
*aggregated* cohort rows (one row per year and course of the catalogue,
however many enrollments stand behind them), joined back over the same,
reused exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortalloc.functions.expressions import ordered_sum, safe_ratio
from cohortalloc.sources.lookups import OVERLAP_YEARS, cohort_years

FISCAL, CALENDAR = "fiscal", "calendar"


def _cohorts(year_matrix: DataFrame) -> DataFrame:
    # 3 rows per fiscal year: bounded by the matrix, always broadcast.
    return F.broadcast(cohort_years(year_matrix))


def cohort_slots(year_matrix: DataFrame) -> DataFrame:
    """(FY, AY): the three years that feed each fiscal year."""
    return _cohorts(year_matrix).select("FY", "AY")


def cohort_feed(year_matrix: DataFrame, matched: DataFrame) -> DataFrame:
    """Unpivoted matrix with the number of matched registrations feeding each slot.

    A fiscal-basis slot counts registrations by academic year, a calendar-basis
    slot by calendar year.
    """
    per_year = (
        matched.select(
            F.explode(
                F.array(
                    F.struct(F.col("time_academic_yr").alias("year"), F.lit(FISCAL).alias("basis")),
                    F.struct(F.col("calendar_year").alias("year"), F.lit(CALENDAR).alias("basis")),
                )
            ).alias("b")
        )
        .groupBy("b.year", "b.basis")
        .agg(F.count(F.lit(1)).alias("n_registrations"))
    )
    slots = cohort_years(year_matrix)
    joined = slots.join(
        per_year,
        (slots.AY == per_year.year) & (slots.year_basis == per_year.basis),
        "left",
    )
    return joined.select(
        "FY", "name", "AY", "status", "year_basis", "year_gap", "years_included",
        F.coalesce(F.col("n_registrations"), F.lit(0)).alias("n_registrations"),
    )


def year_type_hours(matched: DataFrame, year_matrix: DataFrame) -> DataFrame:
    """Students and credit hours per (year, model, course, credit value, basis).

    Every registration is counted twice, once under its academic year
    (basis 'fiscal') and once under its calendar year (basis 'calendar'),
    each kept only if the matrix uses that year with that basis.  One scan,
    one shuffle; the partial aggregate runs before the exchange.
    """
    used = _cohorts(year_matrix).select(
        F.col("AY").alias("year"), F.col("year_basis").alias("aggr_basis")
    ).distinct()
    stacked = matched.select(
        "newid",
        "class_course",
        "credit_hours",
        F.explode(
            F.array(
                F.struct(F.col("time_academic_yr").alias("year"), F.lit(FISCAL).alias("aggr_basis")),
                F.struct(F.col("calendar_year").alias("year"), F.lit(CALENDAR).alias("aggr_basis")),
            )
        ).alias("b"),
    ).select("b.year", "newid", "class_course", "credit_hours", "b.aggr_basis")
    kept = stacked.join(F.broadcast(used), ["year", "aggr_basis"], "left_semi")
    return (
        kept.groupBy("year", "newid", "class_course", "credit_hours", "aggr_basis")
        .agg(F.count(F.lit(1)).alias("n_students_per_class"))
        .select(
            "year",
            "newid",
            "class_course",
            "credit_hours",
            "n_students_per_class",
            (F.col("n_students_per_class") * F.col("credit_hours")).alias(
                "total_credit_hr_per_class"
            ),
            "aggr_basis",
        )
    )


def cohort_weights(hours: DataFrame, year_matrix: DataFrame) -> DataFrame:
    """Share of each (year, course) in its model's credit hours, per fiscal year.

    A fiscal-basis FY reads only fiscal-basis rows, a calendar-basis FY only
    calendar-basis rows.
    """
    slots = _cohorts(year_matrix)
    joined = hours.join(
        slots, (hours.year == slots.AY) & (hours.aggr_basis == slots.year_basis), "inner"
    )
    cumul = joined.groupBy(
        F.col("FY").alias("fiscal_year"),
        F.col("year").alias("acad_year"),
        "newid",
        "class_course",
        "years_included",
        F.col("year_basis").alias("aggr_type"),
        F.col("status").alias("compl_status"),
    ).agg(F.sum("total_credit_hr_per_class").alias("cumul_total_cr_hours"))
    # totals as an aggregate of their own (partial sums first), joined back: a
    # model with many courses is never one task's window.  NULL model ids form
    # one group and meet it again (NULL-safe).
    totals = cumul.groupBy(F.col("fiscal_year").alias("_fy"), F.col("newid").alias("_model")).agg(
        F.sum("cumul_total_cr_hours").alias("grand_total_cr_hours")
    )
    weighted = cumul.join(
        totals, (cumul.fiscal_year == totals._fy) & cumul.newid.eqNullSafe(totals._model)
    )
    return weighted.select(
        "newid",
        "class_course",
        "cumul_total_cr_hours",
        "grand_total_cr_hours",
        safe_ratio(F.col("cumul_total_cr_hours"), F.col("grand_total_cr_hours")).alias(
            "credit_hours_weight"
        ),
        "fiscal_year",
        "acad_year",
        "years_included",
        "aggr_type",
        "compl_status",
    )


def allocated_rates(weights: DataFrame, dollars: DataFrame) -> DataFrame:
    """Dollars per credit hour: amount x weight / cumulative hours.

    Algebraically this is amount / grand total, one rate per (FY, model); the
    operation order of the published rule is kept.
    """
    joined = weights.join(
        dollars,
        weights.newid.eqNullSafe(dollars.newid)
        & (weights.fiscal_year == dollars.fiscal_year_ssi_recognized),
        "inner",
    )
    rate = safe_ratio(
        dollars.ssi_total_amount * weights.credit_hours_weight, weights.cumul_total_cr_hours
    )
    return joined.select(
        weights["*"],
        dollars.inst_code,
        dollars.ssi_total_amount,
        rate.alias("ssi_per_course_per_cr_hours"),
    )


def fiscal_years_per_year(year_matrix: DataFrame) -> DataFrame:
    """(acad_year, fy_count, derived_factor): how many FYs each year feeds and
    the scale factor min(1, 3 / fy_count) that keeps it at three payouts."""
    return (
        cohort_years(year_matrix)
        .groupBy(F.col("AY").alias("acad_year"))
        .agg(F.countDistinct("FY").alias("fy_count"))
        .withColumn("derived_factor", F.least(F.lit(1.0), F.lit(3.0) / F.col("fy_count")))
    )


def literal_overlap_factor(acad_year) -> F.Column:
    return F.when(acad_year.isin(*OVERLAP_YEARS), F.lit(0.75)).otherwise(F.lit(1.0))


def rate_by_acad_year(
    rates: DataFrame, year_matrix: DataFrame | None = None, overlap: str = "literal"
) -> DataFrame:
    """Sum of the rates a (model, course, year) earns over all FYs it feeds.

    Years that feed four fiscal years are scaled by 3/4.  ``overlap='literal'``
    uses the fixed year list; ``overlap='derived'`` computes the factor from
    the matrix (equal on the published matrix).  A group holds one rate per
    fiscal year the year feeds (at most four on the published matrix), so the
    rates are added in sorted order for a reproducible total.
    """
    summed = rates.groupBy("newid", "class_course", "acad_year").agg(
        ordered_sum(F.col("ssi_per_course_per_cr_hours")).alias("total_ssi")
    )
    if overlap == "literal":
        adj = F.when(
            F.col("acad_year").isin(*OVERLAP_YEARS), F.col("total_ssi") * 3 / 4
        ).otherwise(F.col("total_ssi"))
        return summed.select("newid", "class_course", "acad_year", adj.alias("adj_total_ssi"))
    if overlap != "derived" or year_matrix is None:
        raise ValueError("overlap must be 'literal', or 'derived' with a year matrix")
    factors = F.broadcast(fiscal_years_per_year(year_matrix))
    joined = summed.join(factors, "acad_year", "left")
    adj = F.col("total_ssi") * F.coalesce(F.col("derived_factor"), F.lit(1.0))
    return joined.select("newid", "class_course", "acad_year", adj.alias("adj_total_ssi"))


def rate_by_fiscal_year(rates: DataFrame) -> DataFrame:
    """Sum of the rates of a (model, course) per fiscal year paid, over the cohort's years.

    A group holds one rate per year of the cohort (three on the published
    matrix), added in sorted order.
    """
    return rates.groupBy("newid", "class_course", "fiscal_year").agg(
        ordered_sum(F.col("ssi_per_course_per_cr_hours")).alias("adj_total_ssi")
    )


def contributions_per_year(rates: DataFrame, year_matrix: DataFrame) -> DataFrame:
    """Per academic year with allocated rates: FYs fed (matrix and data) and
    both overlap factors, which must agree."""
    per_year = rates.groupBy("acad_year").agg(
        F.count(F.lit(1)).alias("n_rates"),
        F.countDistinct("fiscal_year").alias("n_fiscal_years_paid"),
    )
    joined = per_year.join(F.broadcast(fiscal_years_per_year(year_matrix)), "acad_year", "left")
    return joined.select(
        "acad_year",
        "n_rates",
        "n_fiscal_years_paid",
        "fy_count",
        "derived_factor",
        literal_overlap_factor(F.col("acad_year")).alias("literal_factor"),
    )


# --- doctoral courses ---------------------------------------------------------


def doctoral_hours(basis: DataFrame) -> DataFrame:
    """Students and credit hours per (academic year, course, credit value)."""
    return (
        basis.groupBy("time_academic_yr", "class_course", "credit_hours")
        .agg(F.count(F.lit(1)).alias("n_students_per_class"))
        .withColumn(
            "total_credit_hr_per_class", F.col("n_students_per_class") * F.col("credit_hours")
        )
    )


def doctoral_rates(hours: DataFrame, year_matrix: DataFrame, totals: DataFrame) -> DataFrame:
    """Per (course, FY): the doctoral pool's dollars per credit hour.

    The cohort uses academic years whatever the FY's basis; the grand total is
    over all courses of the FY, so
    the rate is the same for every course of an FY.  A fiscal year with
    several totals has a rate for each.
    """
    slots = _cohorts(year_matrix).select("FY", "AY")
    # NULL-safe (AY is never NULL): keeps the shared basis subtree free of an
    # inferred filter, so the final-row branch can reuse its shuffles.
    joined = hours.join(slots, hours.time_academic_yr.eqNullSafe(slots.AY), "inner")
    cumul = joined.groupBy(F.col("FY").alias("fiscal_year"), "class_course").agg(
        F.sum("total_credit_hr_per_class").alias("cumul_total_cr_hours")
    )
    # one row per fiscal year of the matrix
    grand = cumul.groupBy(F.col("fiscal_year").alias("_fy")).agg(
        F.sum("cumul_total_cr_hours").alias("grand_total_cr_hours")
    )
    weighted = cumul.join(F.broadcast(grand), cumul.fiscal_year == grand._fy).withColumn(
        "credit_hours_weight",
        safe_ratio(F.col("cumul_total_cr_hours"), F.col("grand_total_cr_hours")),
    )
    paid = weighted.join(totals, weighted.fiscal_year == totals.ssi_payout_y1, "left")
    rate = safe_ratio(
        F.col("ssi_y1_payout_total_amount") * F.col("credit_hours_weight"),
        F.col("cumul_total_cr_hours"),
    )
    return paid.select("class_course", "fiscal_year", rate.alias("ssi_per_course_per_cr_hours"))


# --- degrees ------------------------------------------------------------------


def degree_cohort_totals(basis: DataFrame, year_matrix: DataFrame) -> DataFrame:
    """Degrees per (model, FY) over the FY's three academic years.

    Counting rows after the broadcast join equals summing the per-year counts
    the published rule forms first; the partial aggregate before the shuffle
    does that pre-aggregation.
    """
    slots = _cohorts(year_matrix).select("FY", "AY")
    # NULL-safe (AY is never NULL): see doctoral_rates.
    joined = basis.join(slots, basis.degree_ocurred.eqNullSafe(slots.AY), "inner")
    return joined.groupBy("matchid", "FY").agg(F.count(F.lit(1)).alias("total_degrees")).select(
        "matchid", "total_degrees", F.col("FY").alias("fiscal_year")
    )


def doctoral_degree_cohort_totals(basis: DataFrame, year_matrix: DataFrame) -> DataFrame:
    """Degrees per FY over all models (the per-model totals rolled up)."""
    slots = _cohorts(year_matrix).select("FY", "AY")
    joined = basis.join(slots, basis.degree_ocurred.eqNullSafe(slots.AY), "inner")
    return joined.groupBy(F.col("FY").alias("fiscal_year")).agg(
        F.count(F.lit(1)).alias("total_degrees")
    )
