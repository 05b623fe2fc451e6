"""Registration and enrollment shaping: which course registrations are funded.

passed_registrations   distinct passed registrations with positive credit
eligible_enrollments   final, subsidy-eligible enrollment rows with their term
match_outcomes         the two joined once, each row marked matched or not
matched_registrations  one row per matched enrollment
course_dollars         one institution's non-null yearly funding per model
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortalloc.functions.expressions import (
    clean_model_id,
    pad_class_number,
    passing_grade,
    strict_concat,
    strip_final_marker,
)

REGISTRATION_COLUMNS = [
    "class_crse_id", "class_number", "new_class_number", "time_strm", "class_course",
    "class_title_ld", "stdnt_emplid", "campus_id", "uniq_combo_id", "credit_hours",
    "class_grade", "passing_grade", "time_academic_yr",
]


def grade_outcomes(registrations: DataFrame) -> DataFrame:
    """Registrations per (grade, career) with the pass decision of each pair."""
    return (
        registrations.groupBy("class_grade", "stdnt_acad_career_cd")
        .agg(F.count(F.lit(1)).alias("n_registrations"))
        .withColumn(
            "passing_grade", passing_grade(F.col("class_grade"), F.col("stdnt_acad_career_cd"))
        )
    )


def passing_rows(registrations: DataFrame) -> DataFrame:
    """Registrations with credit_hours > 0 and a passing grade, copies included.

    The academic year is cast to an integer here, once.
    """
    rows = registrations.where(F.col("credit_hours") > 0).select(
        "class_crse_id",
        "class_number",
        pad_class_number(F.col("class_number")).alias("new_class_number"),
        "time_strm",
        "class_course",
        "class_title_ld",
        "stdnt_emplid",
        "campus_id",
        strict_concat(
            F.col("class_number"), F.col("class_course"), F.col("time_strm"), F.col("stdnt_emplid")
        ).alias("uniq_combo_id"),
        "credit_hours",
        "class_grade",
        passing_grade(F.col("class_grade"), F.col("stdnt_acad_career_cd")).alias("passing_grade"),
        F.col("time_academic_yr").cast("int").alias("time_academic_yr"),
    )
    return rows.where(F.col("passing_grade") == "Y")


def passed_registrations(registrations: DataFrame) -> DataFrame:
    """Distinct registrations with credit_hours > 0 and a passing grade.

    The DISTINCT is a partial-then-final aggregate: copies of one row are
    collapsed on the map side before the shuffle, so a heavily duplicated
    registration cannot pile up in one task.
    """
    return passing_rows(registrations).distinct()


def eligible_enrollments(
    enrollments: DataFrame,
    term_lookup: DataFrame,
) -> DataFrame:
    """Final ('F'-suffixed) enrollment rows with subsidy_eligible_code = 1.

    Whether the term lookup is broadcast is left to its measured size.
    ``newid`` is the raw model id (subject || level || model, NULL if any
    part is NULL).
    """
    cond = (F.col("subsidy_eligible_code") == 1) & F.col("term_code").endswith("F")
    enr = enrollments.where(cond).withColumn(
        "upd_term_code", strip_final_marker(F.col("term_code"))
    )
    terms = term_lookup.select(
        F.col("term_code").alias("tl_term_code"),
        "strm",
        F.col("term_year").cast("int").alias("calendar_year"),
    )
    joined = enr.join(terms, enr.upd_term_code == terms.tl_term_code)
    return joined.select(
        "class_nbr",
        "student_pid",
        "term_code",
        "upd_term_code",
        "strm",
        "calendar_year",
        strict_concat(
            F.col("enrl_newtax_subject"), F.col("enrl_course_level"), F.col("enrl_newtax_model")
        ).alias("newid"),
        "subsidy_eligible_code",
        "completed_flag",
        "crse_grade_off",
    )


def model_id_cleaning(eligible: DataFrame) -> DataFrame:
    """Raw model ids of eligible enrollments, their cleaned spelling, row counts."""
    return (
        eligible.groupBy(F.col("newid").alias("raw_newid"))
        .agg(F.count(F.lit(1)).alias("n_enrollments"))
        .withColumn("newid", clean_model_id(F.col("raw_newid")))
    )


#: Keys of the match join: (column of the registrations, column of the enrollments).
MATCH_KEYS = (("time_strm", "strm"), ("new_class_number", "class_nbr"), ("campus_id", "student_pid"))
ENROLLMENT_COLUMNS = [
    "term_code", "calendar_year", "newid", "subsidy_eligible_code", "completed_flag", "crse_grade_off",
]
MATCHED, UNMATCHED = "matched", "registration only"


def match_outcomes(passed: DataFrame, eligible: DataFrame, salted: bool = False) -> DataFrame:
    """Every passed registration with its enrollment rows, and which of the two it is.

    The one join of registrations and enrollments (left, three keys) that the
    matched, merged and unmatched registrations are filters of.  Duplicate
    enrollment rows fan out on purpose: each matched enrollment row counts.
    Both sides are large; Spark shuffles them on the three keys (sort-merge
    join) and AQE splits a skewed key range if one appears.  A filter for the
    matched rows turns it into an inner join.

    ``salted=True`` reads facts stored by :mod:`cohortalloc.sinks.buckets`,
    whose hot keys are spread over salts: a registration of a hot key is there
    once per salt, and those copies that met no enrollment under their salt
    are dropped (the key is hot because the enrollments are many, so every
    such registration meets some).
    """
    here = F.lit(True).alias("_enrolled")
    right = eligible.select(
        *[F.col(theirs).alias(f"_{theirs}") for _, theirs in MATCH_KEYS],
        *[F.col(c).alias(f"_e_{c}") for c in ENROLLMENT_COLUMNS],
        *([F.col("_salt").alias("_e_salt")] if salted else []),
        here,
    )
    cond = F.lit(True)
    for ours, theirs in MATCH_KEYS:
        cond = cond & (F.col(ours) == F.col(f"_{theirs}"))
    if salted:
        cond = cond & (F.col("_salt") == F.col("_e_salt"))
    joined = passed.join(right, cond, "left")
    if salted:
        joined = joined.where(F.col("_enrolled").isNotNull() | ~F.col("_hot"))
    side = F.when(F.col("_enrolled").isNotNull(), F.lit(MATCHED)).otherwise(F.lit(UNMATCHED))
    fields = {c: F.col(f"_e_{c}") for c in ENROLLMENT_COLUMNS}
    fields["newid"] = clean_model_id(fields["newid"])
    return joined.select(*REGISTRATION_COLUMNS, *[x.alias(c) for c, x in fields.items()], side.alias("match_side"))


def matched_rows(outcomes: DataFrame) -> DataFrame:
    """Passed registrations with an enrollment, one row per matched enrollment."""
    return outcomes.where(F.col("match_side") == MATCHED).select(*REGISTRATION_COLUMNS, "calendar_year", "newid")


def merged_rows(outcomes: DataFrame) -> DataFrame:
    """Audit variant: every passed registration, with enrollment fields if any."""
    return outcomes.select(
        *REGISTRATION_COLUMNS, "term_code", "newid", "subsidy_eligible_code", "completed_flag", "crse_grade_off"
    )


def distinct_merged_rows(passed: DataFrame, eligible: DataFrame) -> DataFrame:
    """The distinct merged rows of distinct ``passed`` rows.

    Only enrollments that agree in all that is merged could repeat a row, so
    they are made distinct before the join, and the wide rows behind it are
    not shuffled once more.  The calendar year is not merged.
    """
    theirs = [pair[1] for pair in MATCH_KEYS]
    held = eligible.withColumns({"newid": clean_model_id(F.col("newid")), "calendar_year": F.lit(None).cast("int")})
    return merged_rows(match_outcomes(passed, held.select(*theirs, *ENROLLMENT_COLUMNS).distinct()))


def unmatched_rows(outcomes: DataFrame) -> DataFrame:
    """(class number, term, student) of the passed registrations without an enrollment."""
    return (
        outcomes.where(F.col("match_side") == UNMATCHED)
        .select("new_class_number", "time_strm", "campus_id")
        .distinct()
    )


def match_counts(outcomes: DataFrame) -> DataFrame:
    """Rows and distinct registrations per term and side of the match."""
    return outcomes.groupBy("time_strm", "match_side").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.col("uniq_combo_id")).alias("n_registrations")
    )


def matched_registrations(passed: DataFrame, eligible: DataFrame) -> DataFrame:
    """Passed registrations joined to eligible enrollments (inner, 3 keys)."""
    return matched_rows(match_outcomes(passed, eligible))


def merged_registrations(passed: DataFrame, eligible: DataFrame) -> DataFrame:
    """Passed registrations left-joined to eligible enrollments."""
    return merged_rows(match_outcomes(passed, eligible))


def course_dollars(course_allocations: DataFrame, institution: str) -> DataFrame:
    """One institution's funding per (model, fiscal year); NULL amounts dropped."""
    return course_allocations.where(
        (F.col("inst_code") == institution) & F.col("ssi_total_amount").isNotNull()
    ).select("inst_code", "newid", "fiscal_year_ssi_recognized", "ssi_total_amount")
