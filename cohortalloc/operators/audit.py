"""Data-quality audits: model-id agreement, rate ranges, unmatched registrations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortalloc.functions.expressions import clean_model_id, strict_concat, strip_final_marker


def latest_inventory(course_inventory: DataFrame, clean_ids: bool = False) -> DataFrame:
    """Inventory rows at the highest version among eligible rows of their
    (term, subject, catalog number), with ``class_course`` and ``newid``.

    The row joined back need not itself be eligible.  NULL keys never match
    (plain equality), as in the published query.  The per-key maximum is a
    partial-then-final aggregate, so a hot course cannot overload one task.
    """
    keys = ["strm", "crse_subject", "crse_catalog_nbr"]
    latest = (
        course_inventory.where(F.col("hei_subsidy_eligible") == "Y")
        .groupBy(*[F.col(k).alias(f"m_{k}") for k in keys])
        .agg(F.max("strm_version").alias("m_version"))
    )
    cond = course_inventory.strm_version == latest.m_version
    for k in keys:
        cond = cond & (course_inventory[k] == latest[f"m_{k}"])
    joined = course_inventory.join(latest, cond, "inner")
    newid = strict_concat(
        F.col("hei_subsidy_model_subj"), F.col("hei_course_level"), F.col("hei_subsidy_model_code")
    )
    if clean_ids:
        newid = clean_model_id(newid)
    return joined.select(
        course_inventory["*"],
        F.concat(F.col("crse_subject"), F.lit(" "), F.col("crse_catalog_nbr")).alias("class_course"),
        newid.alias("newid"),
    )


def inventory_models(course_inventory: DataFrame) -> DataFrame:
    """The inventory's distinct (course, term, version, model, eligibility); a course may have many equal rows."""
    return course_inventory.select(
        "strm", "strm_version", "crse_subject", "crse_catalog_nbr", "hei_subsidy_model_subj",
        "hei_course_level", "hei_subsidy_model_code", "hei_subsidy_eligible",
    ).distinct()


def model_id_set_difference(dollars: DataFrame, inventory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ids only in the funding table, ids only in the inventory).

    ``subtract`` is a NULL-safe set difference, matching vector membership.
    """
    a = dollars.select("newid").distinct()
    b = inventory.select("newid").distinct()
    return a.subtract(b), b.subtract(a)


def model_id_discrepancy_rows(merged: DataFrame, inventory: DataFrame, unique: bool = False) -> DataFrame:
    """Distinct merged registrations with the inventory's model id and an
    equality flag (a NULL on either side counts as equal).

    Only (course, term, model id) is read from the inventory, and the result
    is DISTINCT.  Both sides are de-duplicated before the join, which then
    makes every row once: the registrations meet one list of model ids (a
    NULL id is one of them) per course and term, and what a course with many
    ids multiplies is never shuffled.  ``unique=True`` is for merged rows that
    are distinct already.
    """
    merged = merged if unique else merged.distinct()
    inv = inventory.groupBy(F.col("class_course").alias("i_class_course"), F.col("strm").alias("i_strm")).agg(
        F.collect_set(F.struct(F.col("newid").alias("ci_newid"))).alias("_ids")
    )
    joined = merged.join(
        inv,
        (merged.class_course == inv.i_class_course) & (merged.time_strm == inv.i_strm),
        "left",
    )
    rows = joined.select(merged["*"], F.explode_outer("_ids").alias("_id")).withColumn("ci_newid", F.col("_id.ci_newid")).drop("_id")
    equal = F.when(F.col("newid") != F.col("ci_newid"), F.lit(0)).otherwise(F.lit(1))
    return rows.withColumn("newid_equal", equal)


def model_id_discrepancy_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("totaln"),
        F.count("newid").alias("non_empty"),
        F.sum("newid_equal").alias("n_equal"),
    )


def _comparable_rows(enrollments: DataFrame, term_lookup: DataFrame) -> DataFrame:
    """Eligible, completed, final enrollment rows with their term."""
    enr = enrollments.where(
        (F.col("subsidy_eligible_code") == 1)
        & (F.col("completed_flag") == 1)
        & F.col("term_code").endswith("F")
    ).select("class_nbr", strip_final_marker(F.col("term_code")).alias("k"))
    terms = term_lookup.select(F.col("term_code").alias("t_code"), "strm")
    return enr.join(terms, enr.k == terms.t_code)


def comparable_terms(enrollments: DataFrame, term_lookup: DataFrame) -> DataFrame:
    """Distinct terms that have eligible, completed, final enrollment rows."""
    return _comparable_rows(enrollments, term_lookup).select("strm").distinct()


def class_number_lengths(enrollments: DataFrame, term_lookup: DataFrame) -> DataFrame:
    """Per comparable term: rows and the longest class number (padding check:
    class numbers are matched as five-character, zero-padded text)."""
    rows = _comparable_rows(enrollments, term_lookup)
    return rows.groupBy("strm").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.length("class_nbr")).alias("max_length"),
        F.min(F.length("class_nbr")).alias("min_length"),
    )


def unmatched_breakdown(
    unmatched: DataFrame, enrollments: DataFrame, term_lookup: DataFrame
) -> DataFrame:
    """Unmatched registrations of comparable terms, re-joined to enrollments,
    counted per eligibility code x completed flag (0, 1, missing).

    The term code looked up for the unmatched rows has no 'F', so only
    non-final enrollment rows can match; rows with no enrollment at all land
    under a NULL eligibility code with a NULL completed flag.
    """
    terms = comparable_terms(enrollments, term_lookup)
    tl = term_lookup.select(F.col("strm").alias("tl_strm"), F.col("term_code").alias("tl_term_code"))
    u = unmatched.join(terms, unmatched.time_strm == terms.strm, "left_semi")
    u = u.join(tl, u.time_strm == tl.tl_strm, "inner").select(
        "new_class_number", "time_strm", F.col("tl_term_code").alias("term_code"), "campus_id"
    )
    cce = enrollments.select(
        F.col("class_nbr").alias("e_class_nbr"),
        F.col("term_code").alias("original_term_code"),
        F.col("student_pid").alias("e_pid"),
        "subsidy_eligible_code",
        "completed_flag",
    )
    results = u.join(
        cce,
        (u.new_class_number == cce.e_class_nbr)
        & (u.term_code == cce.original_term_code)
        & (u.campus_id == cce.e_pid),
        "left",
    )
    flag = F.col("completed_flag")
    who = F.col("campus_id")
    return results.groupBy("subsidy_eligible_code").agg(
        F.count(F.when(flag == 0, who)).alias("completed_0"),
        F.count(F.when(flag == 1, who)).alias("completed_1"),
        F.count(F.when(flag.isNull(), who)).alias("completed_null"),
    )


def rate_range_check(final_courses: DataFrame) -> DataFrame:
    """Per (model, first payout FY): min and max of each payout-year amount.

    Within one (model, FY) every course shares one rate, so min = max unless
    the data are inconsistent.  A group containing a NULL amount reports
    NULL, as a vector minimum without NA removal does.
    """
    aggs = []
    for n in (1, 2, 3):
        c = F.col(f"ssi_y{n}_payout_total_ssi")
        has_null = F.count(F.lit(1)) != F.count(c)
        aggs.append(F.when(~has_null, F.min(c)).alias(f"min_y{n}"))
        aggs.append(F.when(~has_null, F.max(c)).alias(f"max_y{n}"))
    return final_courses.groupBy("newid", "ssi_payout_y1").agg(*aggs)


def doctoral_minimum_check(final_doctoral: DataFrame) -> DataFrame:
    """Per academic year, the smallest payout-year totals of complete rows."""
    aggs = []
    for n in (1, 2, 3):
        c = F.col(f"ssi_y{n}_payout_total_ssi")
        has_null = F.count(F.lit(1)) != F.count(c)
        aggs.append(F.when(~has_null, F.min(c)).alias(f"min_y{n}"))
    return (
        final_doctoral.where(F.col("complete_flag") == "complete")
        .groupBy("time_academic_yr")
        .agg(*aggs)
    )
