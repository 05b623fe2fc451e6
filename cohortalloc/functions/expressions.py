"""Column expressions shared by the pipelines.

All are built-in Catalyst expressions (no Python UDF), so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (grading rule) ---------------------------------------------
# Grades that count as passed.  'PR' (in progress) passes except for
# undergraduates; every other grade, and a missing grade, fails.
PASSING_GRADES = ("A", "A-", "B+", "B", "B-", "C+", "C", "C-", "D+", "D", "D-", "CR", "P", "S")
PROGRESS_GRADE = "PR"
UNDERGRADUATE_CAREER = "UGRD"
# -----------------------------------------------------------------------------

COMPLETE = "complete"
INCOMPLETE = "incomplete"


def passing_grade(grade: Column, career: Column) -> Column:
    """'Y' / 'N'.  A NULL career lets 'PR' pass (the test is "= 'UGRD'")."""
    return (
        F.when(grade.isin(*PASSING_GRADES), F.lit("Y"))
        .when(
            grade == F.lit(PROGRESS_GRADE),
            F.when(career == F.lit(UNDERGRADUATE_CAREER), F.lit("N")).otherwise(F.lit("Y")),
        )
        .otherwise(F.lit("N"))
    )


def strict_concat(*cols: Column) -> Column:
    """Concatenate as text; NULL if any part is NULL (SQL ``||``)."""
    return F.concat(*[c.cast("string") for c in cols])


def pad_class_number(number: Column, width: int = 5) -> Column:
    """Zero-pad to ``width`` characters; a longer number is cut to ``width``."""
    return F.lpad(number.cast("string"), width, "0")


def strip_final_marker(term_code: Column) -> Column:
    """Remove every 'F' from a term code: '20231F' -> '20231'."""
    return F.regexp_replace(term_code, "F", "")


def clean_model_id(newid: Column) -> Column:
    """Model-id spelling fix: 'DOC' -> 'Doc', then 'MED' -> 'Med' (all occurrences)."""
    return F.regexp_replace(F.regexp_replace(newid, "DOC", "Doc"), "MED", "Med")


def completeness_flag(status_y1: Column, status_y3: Column) -> Column:
    """'complete' when the first and the third payout years are final.

    A payout year missing from the year matrix (NULL status) makes the row
    'incomplete'; the flag itself is never NULL.  The second payout year is
    not consulted (it lies between two final years in every matrix in use).
    """
    both = (status_y1 == F.lit(COMPLETE)) & (status_y3 == F.lit(COMPLETE))
    return F.when(both, F.lit(COMPLETE)).otherwise(F.lit(INCOMPLETE))


def downgrade_if_null(flag: Column, *values: Column) -> Column:
    """Turn 'complete' into 'incomplete' where any of ``values`` is NULL."""
    missing = None
    for v in values:
        missing = v.isNull() if missing is None else (missing | v.isNull())
    return F.when(missing & (flag == F.lit(COMPLETE)), F.lit(INCOMPLETE)).otherwise(flag)


def sum_skip_nulls(*cols: Column) -> Column:
    """Row-wise sum treating NULL as 0 (all NULL gives 0)."""
    total = None
    for c in cols:
        term = F.coalesce(c, F.lit(0.0))
        total = term if total is None else total + term
    return total


def sum_propagate_nulls(*cols: Column) -> Column:
    """Row-wise sum that is NULL if any term is NULL."""
    total = None
    for c in cols:
        total = c if total is None else total + c
    return total


def ordered_sum(col: Column) -> Column:
    """Aggregate: sum of a small, bounded group added in ascending order.

    Floating-point addition is not associative, so a plain ``sum`` can differ
    in the last bit between runs depending on the order rows arrive in.
    Sorting first makes the result reproducible.  Only for groups with a
    proven small bound (e.g. one row per fiscal year of the matrix).
    """
    values = F.array_sort(F.collect_list(col))
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x))


def exact_sum(col: Column, scale: int = 17) -> Column:
    """Aggregate: order-independent sum of doubles, taken in DECIMAL(38, scale)."""
    return F.sum(col.cast(f"decimal(38,{scale})"))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL instead of an error on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round_half_even(col: Column, digits: int) -> Column:
    """Rounding as the statistics package does it: of the two neighbouring
    decimals the one nearer in double arithmetic, the even one if equally near.
    (0.15 gives 0.1, 0.25 gives 0.2, 2.45 gives 2.5.)
    """
    unit = F.lit(10.0**digits)
    steps = F.floor(col * unit)
    low, high = steps / unit, (steps + 1) / unit
    below, above = col - low, high - col
    return F.when((below < above) | ((below == above) & (steps % 2 == 0)), low).otherwise(
        F.when(col.isNotNull(), high)
    )


def round_half_up(col: Column, digits: int) -> Column:
    """Ties-away-from-zero rounding, the SQL ``ROUND`` convention."""
    return F.round(col, digits)
