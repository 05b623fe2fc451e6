"""Attaching yearly rates to the enrollment grain, completeness flags, totals.

An enrollment is paid in three fiscal years (y1, y2, y3).  Looking a rate up
for each of them with three joins would shuffle the large side three times
when the rate table is too big to broadcast.  :func:`attach_by_year` instead
folds the rate table to one row per key holding its values by year, joins
once, and reads the three years from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortalloc.functions.expressions import (
    completeness_flag,
    downgrade_if_null,
    sum_propagate_nulls,
    sum_skip_nulls,
)
from cohortalloc.sources.lookups import status_by_fiscal_year

PAYOUT_YEARS = ("ssi_payout_y1", "ssi_payout_y2", "ssi_payout_y3")


def add_payout_years(rows: DataFrame, payout_matrix: DataFrame, year_col: str = "time_academic_yr") -> DataFrame:
    """Inner join to the payout matrix (one row per academic year, broadcast).

    Rows whose year is outside the matrix (or missing) are dropped, as in the
    published rule.  The condition is written NULL-safe: the matrix year is
    never NULL, so the result is the same, but no ``isnotnull(year)`` filter
    is inferred and pushed into the shared registration subtree, which keeps
    that subtree identical to the one the cohort aggregation reads and lets
    Spark reuse its shuffle instead of recomputing it.
    """
    payout = payout_matrix.select(F.col("year").alias("_payout_year"), *PAYOUT_YEARS)
    joined = rows.join(
        F.broadcast(payout), rows[year_col].eqNullSafe(F.col("_payout_year")), "inner"
    )
    return joined.drop("_payout_year")


def attach_by_year(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    year_col: str,
    value_col: str,
    targets: dict[str, str],
    unique: bool = False,
) -> DataFrame:
    """Left-join ``table[value_col]`` for several year columns of ``rows`` at once.

    ``targets`` maps each output column to the year column of ``rows`` to look
    up.  Keys are matched NULL-safely, like the data-frame joins of the
    published rule; several values for one key and year fan a row out, once
    per target, as one left join per target would.  The folded table holds
    the values of a key by year, so the rows are joined (and shuffled) once.
    ``unique=True`` reads the value directly; for tables that come out of an
    aggregate by the keys and the year.
    """
    prefixed = {k: f"_lk_{k}" for k in keys}
    held = [F.col(k).alias(prefixed[k]) for k in keys]
    if unique:
        by_year = table.select(*held, F.col(year_col).alias("_lk_year"), F.col(value_col).alias("_lk_values"))
    else:
        by_year = table.groupBy(*held, F.col(year_col).alias("_lk_year")).agg(
            # wrapped: a NULL value is a match too
            F.collect_list(F.struct(F.col(value_col).alias("v"))).alias("_lk_values")
        )
    folded = by_year.where(F.col("_lk_year").isNotNull()).groupBy(*prefixed.values()).agg(
        F.map_from_entries(F.collect_list(F.struct("_lk_year", "_lk_values"))).alias("_lk_map")
    )
    cond = None
    for k in keys:
        c = rows[k].eqNullSafe(folded[prefixed[k]])
        cond = c if cond is None else cond & c
    out = rows.join(folded, cond, "left")
    for name, year in targets.items():
        found = F.try_element_at(F.col("_lk_map"), F.col(year))
        if unique:
            out = out.withColumn(name, found)
        else:
            out = out.withColumn("_lk_hit", F.explode_outer(found)).withColumn(name, F.col("_lk_hit.v"))
    return out.drop("_lk_map", "_lk_hit", *prefixed.values())


def attach_status(rows: DataFrame, year_matrix: DataFrame, y1: str = "ssi_payout_y1", y3: str = "ssi_payout_y3") -> DataFrame:
    """Add ``complete_flag`` from the status of the first and third payout FY.

    The status table has one row per matrix FY and is broadcast.
    """
    status = status_by_fiscal_year(year_matrix)
    s1 = F.broadcast(status.select(F.col("FY").alias("_fy1"), F.col("status").alias("_st1")))
    s3 = F.broadcast(status.select(F.col("FY").alias("_fy3"), F.col("status").alias("_st3")))
    out = rows.join(s1, rows[y1] == s1._fy1, "left")
    out = out.join(s3, out[y3] == s3._fy3, "left")
    return out.withColumn("complete_flag", completeness_flag(F.col("_st1"), F.col("_st3"))).drop(
        "_fy1", "_st1", "_fy3", "_st3"
    )


def downgrade_missing(rows: DataFrame, *value_cols: str) -> DataFrame:
    """'complete' -> 'incomplete' where any of ``value_cols`` is NULL."""
    return rows.withColumn(
        "complete_flag",
        downgrade_if_null(F.col("complete_flag"), *[F.col(c) for c in value_cols]),
    )


def three_year_total(cols: list[str], skip_nulls: bool) -> Column:
    parts = [F.col(c) for c in cols]
    return sum_skip_nulls(*parts) if skip_nulls else sum_propagate_nulls(*parts)


# --- course pipeline ------------------------------------------------------------

COURSE_AMOUNTS = ("ssi_y1_payout_total_ssi", "ssi_y2_payout_total_ssi", "ssi_y3_payout_total_ssi")


def attach_course_payouts(rows: DataFrame, rates_by_year: DataFrame, key_by: str = "acad_year") -> DataFrame:
    """Per-year rate of the row's (model, course) for each payout year.

    The rate table is keyed by the year the credit was earned while the
    lookup uses the payout fiscal year; that is the published rule and the
    default.  ``key_by='fiscal_year'`` reads rates summed by fiscal year.
    """
    return attach_by_year(
        rows,
        rates_by_year,
        keys=["newid", "class_course"],
        year_col=key_by,
        value_col="adj_total_ssi",
        targets=dict(zip(COURSE_AMOUNTS, PAYOUT_YEARS)),
        unique=True,  # rates are sums by model, course and year
    )


# --- doctoral course pipeline -------------------------------------------------

DOCTORAL_RATES = ("ssi_y1_payout_per_cr_hour", "ssi_y2_payout_per_cr_hour", "ssi_y3_payout_per_cr_hour")


def attach_doctoral_payouts(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Per-credit-hour doctoral rate of each payout FY, by course."""
    return attach_by_year(
        rows,
        rates,
        keys=["class_course"],
        year_col="fiscal_year",
        value_col="ssi_per_course_per_cr_hours",
        targets=dict(zip(DOCTORAL_RATES, PAYOUT_YEARS)),
    )
