"""The four allocation pipelines and the audits, as one lazy plan each.

``Allocation`` wires the operators together over a source bundle (:class:`SourceTables`).
Every attribute is a DataFrame; nothing runs until a caller writes or
collects one.  Intermediate frames that several outputs share (the matched
registrations) appear once in each plan and Spark reuses the exchange; a
caller that writes several outputs first keeps them in the shared checkpoint
folder with ``keep_shared()``.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortalloc.functions.expressions import exact_sum
from cohortalloc.operators import audit, cohorts, degrees, doctoral, payouts, registration
from cohortalloc.operators.payouts import COURSE_AMOUNTS, DOCTORAL_RATES, PAYOUT_YEARS
from cohortalloc.session import configured_checkpoint_dir
from cohortalloc.sinks.writers import delete_folder, store
from cohortalloc.sources.lookups import cohort_years
from cohortalloc.sources.readers import SourceTables

COURSE_OUTPUT = [
    "class_crse_id", "class_number", "new_class_number", "time_strm", "class_course",
    "class_title_ld", "stdnt_emplid", "campus_id", "uniq_combo_id", "credit_hours",
    "class_grade", "passing_grade", "calendar_year", "newid", "time_academic_yr",
    *PAYOUT_YEARS, *COURSE_AMOUNTS, "complete_flag", "ssi_total_all_three_years_combined",
]

DOCTORAL_COURSE_OUTPUT = [
    "class_crse_id", "class_number", "time_strm", "class_course", "class_title_ld",
    "stdnt_emplid", "uniq_combo_id", "credit_hours", "passing_grade", "newid",
    "time_academic_yr", *PAYOUT_YEARS, *COURSE_AMOUNTS, "ssi_total_all_three_years_combined",
    "complete_flag",
]


class Allocation:
    """All pipeline stages for one institution.

    Options (defaults reproduce the published computation):

    overlap            'literal' (fixed 3/4 years) or 'derived' (from the matrix)
    course_recode      downgrade course rows whose payout amount is missing
    times_credit_hours multiply the course amounts by the row's credit hours
    rate_key           'acad_year' (rates by the year credit was earned, as
                       published) or 'fiscal_year' (rates by the year paid)
    clean_inventory_ids  compare cleaned model ids of the inventory in the audits
    own_unmatched      audit the registrations this run leaves unmatched instead
                       of the source table ``unmatched``
    hours              hours per year kept by ``cohortalloc.plans.refresh``, read
                       instead of computing them from the registrations
    match_facts        registrations and enrollments stored for the match join
                       (:func:`cohortalloc.sinks.buckets.store_match_facts`)
    """

    def __init__(
        self,
        sources: SourceTables,
        institution: str,
        overlap: str = "literal",
        course_recode: bool = False,
        times_credit_hours: bool = False,
        rate_key: str = "acad_year",
        clean_inventory_ids: bool = False,
        own_unmatched: bool = False,
        match_facts: tuple[DataFrame, DataFrame] | None = None,
        hours: DataFrame | None = None,
    ):
        self.src = sources
        self.institution = institution
        self.overlap = overlap
        self.course_recode = course_recode
        self.times_credit_hours = times_credit_hours
        self.rate_key = rate_key
        self.clean_inventory_ids = clean_inventory_ids
        self.own_unmatched = own_unmatched
        self.match_facts = match_facts
        self.hours = hours
        self._kept: dict[str, str] = {}

    # --- shared registration stages -------------------------------------------

    @cached_property
    def grade_outcomes(self) -> DataFrame:
        return registration.grade_outcomes(self.src.registrations)

    @cached_property
    def passing(self) -> DataFrame:
        return registration.passing_rows(self.src.registrations)

    @cached_property
    def passed(self) -> DataFrame:
        """Distinct passed registrations."""
        return self.passing.distinct()

    @cached_property
    def eligible(self) -> DataFrame:
        return registration.eligible_enrollments(self.src.enrollments, self.src.term_lookup)

    @cached_property
    def model_id_cleaning(self) -> DataFrame:
        return registration.model_id_cleaning(self.eligible)

    @cached_property
    def match_outcomes(self) -> DataFrame:
        """The one join of registrations and enrollments; matched, merged and unmatched filter it."""
        if self.match_facts:
            return registration.match_outcomes(*self.match_facts, salted=True)
        return registration.match_outcomes(self.passed, self.eligible)

    @cached_property
    def matched(self) -> DataFrame:
        return registration.matched_rows(self.match_outcomes)

    @cached_property
    def match_counts(self) -> DataFrame:
        return registration.match_counts(self.match_outcomes)

    @cached_property
    def matched_plain(self) -> DataFrame:
        """Matched registrations without the calendar year (doctoral basis).

        The same rows as :attr:`matched`, so both pipelines share one join
        (and one checkpoint when the shared frame is materialised)."""
        return self.matched.drop("calendar_year")

    @cached_property
    def dollars(self) -> DataFrame:
        return registration.course_dollars(self.src.course_allocations, self.institution)

    # --- course pipeline --------------------------------------------------------

    @cached_property
    def cohort_years(self) -> DataFrame:
        return cohort_years(self.src.year_matrix)

    @cached_property
    def cohort_feed(self) -> DataFrame:
        return cohorts.cohort_feed(self.src.year_matrix, self.matched)

    @cached_property
    def year_type_hours(self) -> DataFrame:
        if self.hours is not None:
            return self.hours
        return cohorts.year_type_hours(self.matched, self.src.year_matrix)

    @cached_property
    def cohort_weights(self) -> DataFrame:
        return cohorts.cohort_weights(self.year_type_hours, self.src.year_matrix)

    @cached_property
    def allocated_rates(self) -> DataFrame:
        return cohorts.allocated_rates(self.cohort_weights, self.dollars)

    @cached_property
    def rate_by_acad_year(self) -> DataFrame:
        return cohorts.rate_by_acad_year(self.allocated_rates, self.src.year_matrix, self.overlap)

    @cached_property
    def contributions_per_year(self) -> DataFrame:
        return cohorts.contributions_per_year(self.allocated_rates, self.src.year_matrix)

    @cached_property
    def payout_years(self) -> DataFrame:
        return payouts.add_payout_years(self.matched, self.src.payout_matrix)

    @cached_property
    def course_payouts(self) -> DataFrame:
        if self.rate_key == "fiscal_year":
            rates = cohorts.rate_by_fiscal_year(self.allocated_rates)
        else:
            rates = self.rate_by_acad_year
        return payouts.attach_course_payouts(self.payout_years, rates, self.rate_key)

    @cached_property
    def course_completeness(self) -> DataFrame:
        flagged = payouts.attach_status(self.course_payouts, self.src.year_matrix)
        if self.course_recode:
            flagged = payouts.downgrade_missing(flagged, *COURSE_AMOUNTS)
        return flagged

    @cached_property
    def course_subsidy(self) -> DataFrame:
        rows = self.course_completeness
        if self.times_credit_hours:
            rows = rows.withColumns({c: F.col("credit_hours") * F.col(c) for c in COURSE_AMOUNTS})
        rows = rows.withColumn(
            "ssi_total_all_three_years_combined",
            payouts.three_year_total(list(COURSE_AMOUNTS), skip_nulls=True),
        )
        return rows.select(*COURSE_OUTPUT)

    @cached_property
    def course_reconciliation(self) -> DataFrame:
        """Allocated dollars per academic year next to recognised dollars per FY."""
        def cents(total):
            return F.round(total, 2).cast("double")

        allocated = self.course_subsidy.groupBy(F.col("time_academic_yr").alias("year")).agg(
            cents(F.coalesce(exact_sum(F.col("ssi_total_all_three_years_combined")), F.lit(0))).alias(
                "total_amount"
            )
        )
        recognised = self.dollars.groupBy(F.col("fiscal_year_ssi_recognized").alias("year")).agg(
            cents(exact_sum(F.col("ssi_total_amount"))).alias("total_amount")
        )
        return allocated.withColumn("measure", F.lit("allocated_by_acad_year")).unionByName(
            recognised.withColumn("measure", F.lit("recognised_by_fiscal_year"))
        )

    @cached_property
    def rate_range_check(self) -> DataFrame:
        return audit.rate_range_check(self.course_subsidy)

    # --- doctoral course pipeline -------------------------------------------------

    @cached_property
    def doctoral_basis(self) -> DataFrame:
        return doctoral.doctoral_course_basis(
            self.matched_plain, self.src.course_allocations, self.src.doctoral_subsidy, self.institution
        )

    @cached_property
    def doctoral_totals(self) -> DataFrame:
        return doctoral.doctoral_totals(self.doctoral_basis)

    @cached_property
    def doctoral_hours(self) -> DataFrame:
        return cohorts.doctoral_hours(self.doctoral_basis)

    @cached_property
    def doctoral_rates(self) -> DataFrame:
        return cohorts.doctoral_rates(self.doctoral_hours, self.src.year_matrix, self.doctoral_totals)

    @cached_property
    def doctoral_subsidy(self) -> DataFrame:
        rows = self.doctoral_basis.drop("ssi_y1_payout_total_amount")
        rows = payouts.attach_doctoral_payouts(rows, self.doctoral_rates)
        rows = payouts.attach_status(rows, self.src.year_matrix)
        rows = payouts.downgrade_missing(rows, *DOCTORAL_RATES)
        hours = F.col("credit_hours")
        rows = rows.withColumns(
            {amt: hours * F.col(rate) for amt, rate in zip(COURSE_AMOUNTS, DOCTORAL_RATES)}
        ).withColumn(
            "ssi_total_all_three_years_combined",
            hours * payouts.three_year_total(list(DOCTORAL_RATES), skip_nulls=False),
        )
        return rows.select(*DOCTORAL_COURSE_OUTPUT)

    @cached_property
    def doctoral_minimum_check(self) -> DataFrame:
        return audit.doctoral_minimum_check(self.doctoral_subsidy)

    # --- degree pipelines -----------------------------------------------------------

    @cached_property
    def degree_basis(self) -> DataFrame:
        return degrees.degree_basis(
            self.src.completions, self.src.acad_plans, self.src.degree_allocations, self.institution
        )

    @cached_property
    def degree_cohort_totals(self) -> DataFrame:
        return cohorts.degree_cohort_totals(self.degree_basis, self.src.year_matrix)

    @cached_property
    def degree_counts(self) -> DataFrame:
        return degrees.attach_degree_counts(self.degree_basis, self.degree_cohort_totals)

    @cached_property
    def degree_dollars(self) -> DataFrame:
        return degrees.attach_degree_dollars(self.degree_counts)

    @cached_property
    def degree_averages(self) -> DataFrame:
        return degrees.average_per_degree(self.degree_dollars)

    @cached_property
    def degree_combos(self) -> DataFrame:
        return degrees.completions_on_active_plans(self.src.completions, self.src.acad_plans)

    @cached_property
    def degree_subsidy(self) -> DataFrame:
        dollars = degrees.model_dollars(self.src.degree_allocations, self.institution)
        return self._degrees(self.degree_combos, dollars, by_model=True)

    def _degrees(self, combos: DataFrame, dollars: DataFrame, by_model: bool) -> DataFrame:
        """Final degree rows: everything a model's years hold comes from one look-up."""
        years = degrees.model_years(combos, dollars, self.src.year_matrix, by_model)
        rows = degrees.attach_model_years(combos, years, by_model)
        return degrees.finish_degrees(degrees.average_per_degree(rows), self.src.year_matrix)

    @cached_property
    def degree_stats(self) -> DataFrame:
        return degrees.degree_stats(self.degree_subsidy, ["matchid"])

    @cached_property
    def degree_flag_check(self) -> DataFrame:
        return degrees.degree_flag_check(self.degree_subsidy)

    @cached_property
    def doctoral_degree_basis(self) -> DataFrame:
        return degrees.doctoral_degree_basis(
            self.src.completions, self.src.acad_plans, self.src.doctoral_subsidy, self.institution
        )

    @cached_property
    def doctoral_degree_cohorts(self) -> DataFrame:
        return cohorts.doctoral_degree_cohort_totals(self.doctoral_degree_basis, self.src.year_matrix)

    @cached_property
    def doctoral_degree_subsidy(self) -> DataFrame:
        combos = degrees.completions_on_active_plans(self.src.completions, self.src.acad_plans, phd_only=True)
        dollars = degrees.pool_dollars(self.src.doctoral_subsidy, self.institution)
        return self._degrees(combos, dollars, by_model=False)

    @cached_property
    def doctoral_degree_stats(self) -> DataFrame:
        return degrees.degree_stats(self.doctoral_degree_subsidy, ["degree_ocurred", "matchid"])

    @cached_property
    def doctoral_degree_flag_check(self) -> DataFrame:
        return degrees.degree_flag_check(self.doctoral_degree_subsidy)

    # --- combined output tables -------------------------------------------------------

    @cached_property
    def combined_course_table(self) -> DataFrame:
        """Course and doctoral course rows in one table, aligned by column name."""
        return self.course_subsidy.withColumn("source", F.lit("course")).unionByName(
            self.doctoral_subsidy.withColumn("source", F.lit("doctoral_course")),
            allowMissingColumns=True,
        )

    @cached_property
    def combined_degree_table(self) -> DataFrame:
        return self.degree_subsidy.withColumn("source", F.lit("degree")).unionByName(
            self.doctoral_degree_subsidy.withColumn("source", F.lit("doctoral_degree")),
            allowMissingColumns=True,
        )

    # --- audits -------------------------------------------------------------------------

    @cached_property
    def latest_inventory(self) -> DataFrame:
        return audit.latest_inventory(self.src.course_inventory, self.clean_inventory_ids)

    @cached_property
    def model_id_set_difference(self) -> tuple[DataFrame, DataFrame]:
        return audit.model_id_set_difference(self.dollars, self.latest_inventory)

    @cached_property
    def merged(self) -> DataFrame:
        return registration.merged_rows(self.match_outcomes)

    @cached_property
    def merged_distinct(self) -> DataFrame:
        """The distinct merged rows.  A match join that is kept or stored is read; else copies go before the join."""
        if self.match_facts or "match_outcomes" in self._kept:
            return self.merged.distinct()
        return registration.distinct_merged_rows(self.passed, self.eligible)

    @cached_property
    def model_id_discrepancy_rows(self) -> DataFrame:
        # only the distinct model ids of a course and term are compared
        inventory = audit.latest_inventory(audit.inventory_models(self.src.course_inventory), self.clean_inventory_ids)
        return audit.model_id_discrepancy_rows(self.merged_distinct, inventory, unique=True)

    @cached_property
    def model_id_discrepancies(self) -> DataFrame:
        return audit.model_id_discrepancy_counts(self.model_id_discrepancy_rows)

    @cached_property
    def comparable_terms(self) -> DataFrame:
        return audit.comparable_terms(self.src.enrollments, self.src.term_lookup)

    @cached_property
    def class_number_lengths(self) -> DataFrame:
        return audit.class_number_lengths(self.src.enrollments, self.src.term_lookup)

    @cached_property
    def unmatched(self) -> DataFrame:
        return registration.unmatched_rows(self.match_outcomes) if self.own_unmatched else self.src.unmatched

    @cached_property
    def unmatched_breakdown(self) -> DataFrame:
        return audit.unmatched_breakdown(self.unmatched, self.src.enrollments, self.src.term_lookup)

    # --- materialisation ------------------------------------------------------------------

    def keep(self, *names: str) -> None:
        """Write the named frames to the shared checkpoint folder, once, and read them back.

        The files survive the loss of an executor, and later outputs read
        only the columns they need.  :meth:`forget` deletes them.
        """
        for name in names:
            if name not in self._kept:
                frame = getattr(self, name)
                spark = frame.sparkSession
                path = f"{configured_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
                frame.write.parquet(path)
                self.__dict__[name] = spark.read.schema(frame.schema).parquet(path)
                self._kept[name] = path

    def keep_at(self, name: str, path: str) -> None:
        """Write the named frame to a folder, which is replaced, and read it back in place of the frame."""
        self.__dict__[name] = store(getattr(self, name), path)

    def keep_shared(self) -> None:
        """Keep the match join, which all course outputs and audits filter."""
        self.keep("match_outcomes")

    def forget(self) -> None:
        """Delete the kept files; the frames that read them are of no use afterwards."""
        for path in self._kept.values():
            delete_folder(self.match_outcomes.sparkSession, path)
        self._kept.clear()
