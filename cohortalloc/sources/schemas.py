"""Typed schemas of every source the pipelines read.

Types are fixed here once; readers cast to them so that no query relies on
implicit text/number coercion.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


S, I, L, D = StringType(), IntegerType(), LongType(), DoubleType()
# credit hours may be fractional; ids are text (leading zeros, letters)
HOURS = DecimalType(9, 2)

YEAR_MATRIX = _schema(
    ("FY", I), ("AY_1", I), ("AY_2", I), ("AY_3", I),
    ("status", S), ("year_basis", S), ("year_gap", I),
)

PAYOUT_MATRIX = _schema(
    ("year", I), ("ssi_payout_y1", I), ("ssi_payout_y2", I), ("ssi_payout_y3", I),
    ("gap", I), ("year_basis", S),
)

REGISTRATIONS = _schema(
    ("class_crse_id", S), ("class_number", S), ("time_strm", I), ("class_course", S),
    ("class_title_ld", S), ("stdnt_emplid", S), ("campus_id", S), ("credit_hours", HOURS),
    ("class_grade", S), ("stdnt_acad_career_cd", S), ("time_academic_yr", S),
)

ENROLLMENTS = _schema(
    ("class_nbr", S), ("student_pid", S), ("term_code", S), ("enrl_newtax_subject", S),
    ("enrl_course_level", S), ("enrl_newtax_model", S), ("subsidy_eligible_code", I),
    ("completed_flag", I), ("crse_grade_off", S),
)

TERM_LOOKUP = _schema(("term_code", S), ("strm", I), ("term_year", S))

COURSE_ALLOCATIONS = _schema(
    ("inst_code", S), ("newid", S), ("fiscal_year_ssi_recognized", I), ("ssi_total_amount", D),
)

DOCTORAL_SUBSIDY = _schema(
    ("inst", S), ("fiscal_year", I), ("completed_fte", D), ("degrees", D),
)

COMPLETIONS = _schema(
    ("stdnt_emplid", S), ("completion_term", I), ("time_academic_year", I),
    ("plan_acad_plan_ld", S), ("plan_acad_plan_code", S), ("degree_cd", S),
)

ACAD_PLANS = _schema(("strm", I), ("acad_plan", S), ("matchid", S), ("eff_status", S))

DEGREE_ALLOCATIONS = _schema(
    ("inst", S), ("match_id", S), ("fiscal_year", I), ("total_ssi", D),
)

COURSE_INVENTORY = _schema(
    ("strm", I), ("strm_version", L), ("crse_subject", S), ("crse_catalog_nbr", S),
    ("hei_subsidy_model_subj", S), ("hei_course_level", S), ("hei_subsidy_model_code", S),
    ("hei_subsidy_eligible", S),
)

UNMATCHED = _schema(("new_class_number", S), ("time_strm", I), ("campus_id", S))

SOURCES: dict[str, StructType] = {
    "registrations": REGISTRATIONS,
    "enrollments": ENROLLMENTS,
    "term_lookup": TERM_LOOKUP,
    "course_allocations": COURSE_ALLOCATIONS,
    "doctoral_subsidy": DOCTORAL_SUBSIDY,
    "completions": COMPLETIONS,
    "acad_plans": ACAD_PLANS,
    "degree_allocations": DEGREE_ALLOCATIONS,
    "course_inventory": COURSE_INVENTORY,
    "unmatched": UNMATCHED,
}
