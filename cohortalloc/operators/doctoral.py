"""Doctoral course basis: doctoral models are paid from a separate yearly pool.

In the ordinary allocation the doctoral models carry an amount of 0; the
rows that matter here are the matched registrations of a 'Doc' model whose
allocation for FY = academic year + 1 is exactly 0, paired with the yearly
doctoral course total of that FY.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def doctoral_course_basis(
    matched: DataFrame,
    course_allocations: DataFrame,
    doctoral_subsidy: DataFrame,
    institution: str,
) -> DataFrame:
    """Distinct doctoral rows with payout years and the FY's doctoral total.

    ``matched`` is the matched-registration frame without calendar year.  NULL
    allocation amounts are kept in the allocation frame (they simply fail the
    ``= 0`` test).
    """
    alloc = course_allocations.where(F.col("inst_code") == institution).select(
        F.col("inst_code"),
        F.col("newid").alias("a_newid"),
        F.col("fiscal_year_ssi_recognized").alias("a_fy"),
        F.col("ssi_total_amount").alias("a_amount"),
    ).where(F.col("a_amount") == 0)
    docs = matched.where(F.col("newid").contains("Doc"))
    joined = docs.join(
        alloc,
        (docs.time_academic_yr == alloc.a_fy - 1) & (docs.newid == alloc.a_newid),
        "inner",
    )
    rows = joined.select(
        docs["*"],
        F.col("inst_code"),
        F.col("a_fy").alias("ssi_payout_y1"),
        (F.col("a_fy") + 1).alias("ssi_payout_y2"),
        (F.col("a_fy") + 2).alias("ssi_payout_y3"),
    ).distinct()
    pool = doctoral_subsidy.where(F.col("inst") == institution).select(
        F.col("fiscal_year").alias("d_fy"), F.col("completed_fte").alias("ssi_y1_payout_total_amount")
    )
    return rows.join(pool, rows.ssi_payout_y1 == pool.d_fy, "inner").drop("d_fy")


def doctoral_totals(basis: DataFrame) -> DataFrame:
    """Distinct (first payout FY, doctoral course total)."""
    return basis.select("ssi_payout_y1", "ssi_y1_payout_total_amount").distinct()
