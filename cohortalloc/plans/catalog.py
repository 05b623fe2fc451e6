"""Named queries over the fixture views: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query builds the whole plan from the scale-factor directory, so it reads
the full tables.  Floating-point outputs that are sums over many rows are
rounded where they are published (money to cents, rates to 1e-6) so that the
result does not depend on the order in which partitions are added.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cohortalloc.operators.metrics import metrics_frame, observe
from cohortalloc.plans.pipelines import Allocation
from cohortalloc.plans.refresh import read_hours, refresh_hours, store_hours
from cohortalloc.session import configured_checkpoint_dir
from cohortalloc.sinks.buckets import store_match_facts
from cohortalloc.sinks.publish import publish, read_published
from cohortalloc.sinks.writers import append_table, create_table, overwrite_table, store, write_csv, write_parquet
from cohortalloc.sources import schemas
from cohortalloc.sources.fixtures import fixture_sources
from cohortalloc.sources.readers import clean_text, cleaning_report, read_csv
from cohortalloc.sources.sql_text import run_sql, sql_text
from cohortalloc.sources.year_facts import read_by_year, write_by_year, years_in_use

FIXTURE_INSTITUTION = "INST"
RATE_DIGITS = 6
MONEY_DIGITS = 2


def allocation(spark: SparkSession, sf_dir: str, **options) -> Allocation:
    return Allocation(fixture_sources(spark, sf_dir), FIXTURE_INSTITUTION, **options)


def _round(df: DataFrame, digits: int, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def published(df: DataFrame) -> DataFrame:
    """Decimal columns (credit hours and their sums) as doubles."""
    decimals = [f.name for f in df.schema.fields if f.dataType.typeName() == "decimal"]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


#: What a course query needs for its rows and for their rates, each computed once and stored.
COURSE_STEPS = ("matched", "year_type_hours", "allocated_rates")
#: The two sides of the match join, stored one after the other: the shuffles behind a side go before the next one's come.
MATCH_SIDES = ("passed", "eligible")


def _kept(spark: SparkSession, sf_dir: str, query: str, frames: tuple[str, ...], **options) -> Allocation:
    """An allocation whose named frames are stored for one query, each read by the later ones."""
    alloc = allocation(spark, sf_dir, **options)
    for frame in frames:
        alloc.keep_at(frame, _shared_path(spark, f"{query}_{frame}", sf_dir))
    return alloc


def _stage(
    name: str,
    round_cols: tuple[list[str], int] | None = None,
    order_by: list[str] | None = None,
    kept: tuple[str, ...] = (),
):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = published(getattr(_kept(spark, sf_dir, name, kept), name))
        if round_cols:
            cols, digits = round_cols
            df = _round(df, digits, cols)
        if order_by:
            # presentation order of the published report (a range-partitioned sort)
            df = df.orderBy(*order_by)
        return df

    run.__name__ = name
    return run


RATE_COLS = ["ssi_per_course_per_cr_hours"]
COURSE_AMOUNT_COLS = [
    "ssi_y1_payout_total_ssi", "ssi_y2_payout_total_ssi", "ssi_y3_payout_total_ssi",
    "ssi_total_all_three_years_combined",
]


def _models_only_in_dollars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocation(spark, sf_dir).model_id_set_difference[0]


def _models_only_in_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocation(spark, sf_dir).model_id_set_difference[1]


def _recoded_course_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _kept(spark, sf_dir, "course_completeness_recoded", COURSE_STEPS, course_recode=True).course_completeness
    return _round(published(df), RATE_DIGITS, COURSE_AMOUNT_COLS[:3])


def _derived_overlap_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = allocation(spark, sf_dir, overlap="derived").rate_by_acad_year
    return _round(df, RATE_DIGITS, ["adj_total_ssi"])


def _clean_text_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    regs = fixture_sources(spark, sf_dir).registrations
    seeded = seeded_text(regs)
    return seeded.select(
        "class_crse_id",
        "stdnt_emplid",
        "time_strm",
        clean_text(F.col("raw_title"), width=12).alias("class_title_ld"),
        clean_text(F.col("raw_grade")).alias("class_grade"),
    )


def _fixed_name(kind: str, sf_dir: str) -> str:
    """One name per query and input folder: a repeated call replaces what the last one wrote."""
    return f"{kind}_{zlib.crc32(sf_dir.rstrip('/').encode()):08x}"


def _shared_path(spark: SparkSession, kind: str, sf_dir: str) -> str:
    """A folder on the shared storage of the session."""
    root = configured_checkpoint_dir(spark) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root}/{_fixed_name(kind, sf_dir)}"


def _csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded registration text written as CSV and read back: bound by name, cleaned, then cast."""
    seeded = seeded_text(fixture_sources(spark, sf_dir).registrations)
    path = _shared_path(spark, "csv_load", sf_dir)
    # the file has its own column order
    write_csv(seeded.select("raw_note", "raw_grade", "time_strm", "raw_title", "class_crse_id", "stdnt_emplid"), path)
    schema = StructType([StructField(f.name, f.dataType, True) for f in seeded.schema.fields])
    return read_csv(spark, path, schema, widths={"raw_title": 12})


def _table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The degree table created, loaded, loaded again and appended to; rows counted by source."""
    alloc = allocation(spark, sf_dir)
    table = _fixed_name("table_load", sf_dir)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    degrees = alloc.degree_subsidy.withColumn("source", F.lit("degree"))
    create_table(spark, degrees, table)
    overwrite_table(degrees, table)
    overwrite_table(degrees, table)
    append_table(spark, alloc.doctoral_degree_subsidy.withColumn("source", F.lit("doctoral_degree")), table)
    return _by_source(spark.table(table))


def _by_source(df: DataFrame) -> DataFrame:
    return df.groupBy("source", "complete_flag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("total_all_three_years_ssi_per_degree").alias("n_totals")
    )


def _published_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined degree table published in one step, its second part loaded again; rows read back."""
    alloc = allocation(spark, sf_dir)
    path = _shared_path(spark, "published_load", sf_dir)
    doctoral = alloc.doctoral_degree_subsidy
    publish(spark, path, {"degree": alloc.degree_subsidy, "doctoral_degree": doctoral}, replace=True)
    publish(spark, path, {"doctoral_degree": doctoral})  # a repeated append replaces its part
    return read_published(spark, path)


def _matched_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched registrations from facts stored in buckets of the match keys: a join without a shuffle."""
    alloc = allocation(spark, sf_dir)
    facts = store_match_facts(spark, alloc.passed, alloc.eligible, _fixed_name("match", sf_dir), buckets=8)
    return published(allocation(spark, sf_dir, match_facts=facts).matched)


def _own_unmatched_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocation(spark, sf_dir, own_unmatched=True).unmatched_breakdown


def _octet_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with characters of two to four octets, cleaned and cut to 12 octets."""
    seeded = accented_titles(fixture_sources(spark, sf_dir).registrations)
    return seeded.select(
        "class_crse_id", "stdnt_emplid", "time_strm", clean_text(F.col("raw_title"), width=12).alias("class_title_ld")
    )


def _cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many texts the load cleaning empties, cuts and replaces, by column."""
    regs = fixture_sources(spark, sf_dir).registrations
    seeded = accented_titles(seeded_text(regs), "raw_note").select("raw_title", "raw_grade", "raw_note")
    return cleaning_report(seeded, widths={"raw_title": 12, "raw_note": 16})


def _sql_course_dollars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funding query given as an SQL file with a parameter."""
    src = fixture_sources(spark, sf_dir)
    sources = {"course_allocations": src.course_allocations}
    params = {"institution": FIXTURE_INSTITUTION}
    return run_sql(spark, sql_text("course_dollars"), sources, params, schemas.COURSE_ALLOCATIONS)


def _sql_class_number_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixture_sources(spark, sf_dir)
    sources = {"enrollments": src.enrollments, "term_lookup": src.term_lookup}
    wanted = StructType.fromDDL("strm int, n_rows bigint, max_length int, min_length int")
    return run_sql(spark, sql_text("class_number_lengths"), sources, {"eligible": 1, "completed": 1}, wanted)


def _degree_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is observed while the degree output is written."""
    frame, seen = observe(allocation(spark, sf_dir).degree_subsidy, "degree_subsidy")
    write_parquet(frame, _shared_path(spark, "degree_run", sf_dir))
    return metrics_frame(spark, seen.get)


def _refreshed_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates from kept hours of which two years were computed again."""
    alloc = _kept(spark, sf_dir, "refreshed_rates", MATCH_SIDES)
    path = _shared_path(spark, "hours", sf_dir)
    # matched once; the hours, of all years and of the changed ones, read what they need of it
    matched = alloc.matched.select(
        "class_crse_id", "newid", "class_course", "credit_hours", "time_academic_yr", "calendar_year"
    )
    matched, matrix = store(matched, _shared_path(spark, "refreshed_rates_matched", sf_dir)), alloc.src.year_matrix
    changed = [2018, 2019]
    # the state before the change: part of two years' registrations was not there yet
    late = F.col("time_academic_yr").isin(changed) & (F.col("class_crse_id").cast("long") % 3 == 0)
    store_hours(matched.where(~late), matrix, path)
    refresh_hours(matched, matrix, path, changed + [y + 1 for y in changed] + [y - 1 for y in changed])
    hours = read_hours(spark, path, alloc.year_type_hours.schema)
    return _round(published(allocation(spark, sf_dir, hours=hours).allocated_rates), 9, ["credit_hours_weight", *RATE_COLS])


def _registrations_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrations kept by academic year, those of the matrices' years read back and counted."""
    src = fixture_sources(spark, sf_dir)
    path = _shared_path(spark, "by_year", sf_dir)
    write_by_year(src.registrations, path)
    held = read_by_year(spark, path, schemas.REGISTRATIONS, years_in_use(src.year_matrix, src.payout_matrix))
    return held.groupBy("time_academic_yr").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("credit_hours").cast("double").alias("hours")
    )


def _positioned(name: str, order_by: list[str]):
    """A report in its published order, with the position of every row (a few rows per fiscal year)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = published(getattr(allocation(spark, sf_dir), name))
        rest = [c for c in df.columns if c not in order_by]
        # rows are bounded by the calendar, so one task may number them
        return df.withColumn("position", F.row_number().over(Window.orderBy(*order_by, *rest)))

    return run


def _rates_by_fiscal_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _kept(spark, sf_dir, "course_payouts_by_fiscal_year", COURSE_STEPS, rate_key="fiscal_year").course_payouts
    return _round(published(df), RATE_DIGITS, COURSE_AMOUNT_COLS[:3])


def _latest_inventory_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocation(spark, sf_dir, clean_inventory_ids=True).latest_inventory


def seeded_text(regs: DataFrame) -> DataFrame:
    """Registration text fields seeded, by key, with padding, blanks and 'NULL'."""
    k = F.col("class_crse_id").cast("long") % 5
    title = F.col("class_title_ld")
    raw_title = (
        F.when(k == 0, F.concat(F.lit("  "), title, F.lit("   ")))
        .when(k == 1, F.lit(""))
        .when(k == 2, F.lit("NULL"))
        .when(k == 3, F.when(F.col("time_strm") % 2 == 0, F.lit("    ")).otherwise(F.lit(" NULL")))
        .otherwise(F.concat(title, F.lit(" "), title))
    )
    raw_grade = F.when(k == 2, F.lit("NULL")).otherwise(F.concat(F.col("class_grade"), F.lit(" ")))
    # what RFC 4180 quotes: quotes, commas, line breaks of both kinds, a backslash
    raw_note = (
        F.when(k == 0, F.concat(F.lit('said "'), title, F.lit('", twice ""')))
        .when(k == 1, F.concat(title, F.lit("\nsecond, line\n\n\"third\"")))
        .when(k == 2, F.concat(F.lit('"'), title, F.lit('"')))
        .when(k == 3, F.concat(F.lit("a\\b\\\""), title, F.lit("\r\nend")))
        .otherwise(F.lit(","))
    )
    return regs.select(
        "class_crse_id", "stdnt_emplid", "time_strm",
        raw_title.alias("raw_title"), raw_grade.alias("raw_grade"), raw_note.alias("raw_note"),
    )


def accented_titles(df: DataFrame, source: str = "class_title_ld") -> DataFrame:
    """``df`` with vowels of a text column turned to characters of two, three and four octets."""
    raw = F.translate(F.col(source), "aeo", "é€😀")
    return df.withColumn("raw_title" if source == "class_title_ld" else source, raw)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "passing_grade": _stage("grade_outcomes"),
    "passed_registrations": _stage("passed"),
    "eligible_enrollments": _stage("eligible"),
    "clean_model_ids": _stage("model_id_cleaning"),
    "matched_registrations": _stage("matched"),
    "course_dollars": _stage("dollars"),
    "cohort_years": _stage("cohort_feed"),
    "year_type_hours": _stage("year_type_hours"),
    "cohort_weights": _stage("cohort_weights", (["credit_hours_weight"], 9)),
    "allocated_rates": _stage("allocated_rates", (["credit_hours_weight", *RATE_COLS], 9)),
    "rate_by_acad_year": _stage("rate_by_acad_year", (["adj_total_ssi"], RATE_DIGITS)),
    "rate_by_acad_year_derived": _derived_overlap_rates,
    "contributions_per_year": _stage("contributions_per_year"),
    "payout_years": _stage("payout_years"),
    "course_payouts": _stage("course_payouts", (COURSE_AMOUNT_COLS[:3], RATE_DIGITS), kept=COURSE_STEPS),
    "course_completeness": _stage("course_completeness", (COURSE_AMOUNT_COLS[:3], RATE_DIGITS), kept=COURSE_STEPS),
    "course_completeness_recoded": _recoded_course_completeness,
    # rows and rates share the shuffle of the DISTINCT, so its rows are stored as they come into it
    "course_subsidy": _stage("course_subsidy", (COURSE_AMOUNT_COLS, RATE_DIGITS), kept=("passing", "eligible")),
    "course_reconciliation": _stage("course_reconciliation", (["total_amount"], MONEY_DIGITS), kept=COURSE_STEPS),
    "doctoral_basis": _stage("doctoral_basis"),
    "doctoral_totals": _stage("doctoral_totals", order_by=["ssi_payout_y1"]),
    "doctoral_hours": _stage("doctoral_hours"),
    "doctoral_rates": _stage("doctoral_rates", (RATE_COLS, 9)),
    "doctoral_subsidy": _stage("doctoral_subsidy", (COURSE_AMOUNT_COLS, RATE_DIGITS)),
    "doctoral_minimum_check": _stage(
        "doctoral_minimum_check", (["min_y1", "min_y2", "min_y3"], RATE_DIGITS)
    ),
    "degree_basis": _stage("degree_basis"),
    "degree_cohort_totals": _stage("degree_cohort_totals"),
    "degree_counts": _stage("degree_counts"),
    "degree_dollars": _stage("degree_dollars"),
    "degree_averages": _stage("degree_averages"),
    "degree_subsidy": _stage("degree_subsidy"),
    "degree_stats": _stage("degree_stats", (["mean", "median"], RATE_DIGITS)),
    "degree_flag_check": _stage("degree_flag_check", order_by=["ssi_payout_y1"]),
    "doctoral_degree_basis": _stage("doctoral_degree_basis", order_by=["degree_ocurred"]),
    "doctoral_degree_cohorts": _stage("doctoral_degree_cohorts"),
    "doctoral_degree_subsidy": _stage("doctoral_degree_subsidy"),
    "doctoral_degree_stats": _stage("doctoral_degree_stats", (["mean", "median"], RATE_DIGITS)),
    "doctoral_degree_flag_check": _stage("doctoral_degree_flag_check", order_by=["ssi_payout_y1"]),
    "combined_course_table": _stage("combined_course_table", (COURSE_AMOUNT_COLS, RATE_DIGITS), kept=COURSE_STEPS),
    "combined_degree_table": _stage("combined_degree_table"),
    "rate_range_check": _stage(
        "rate_range_check",
        ([f"{m}_y{n}" for n in (1, 2, 3) for m in ("min", "max")], RATE_DIGITS),
        kept=COURSE_STEPS,
    ),
    "latest_inventory": _stage("latest_inventory"),
    "models_only_in_dollars": _models_only_in_dollars,
    "models_only_in_inventory": _models_only_in_inventory,
    "model_id_discrepancy_rows": _stage("model_id_discrepancy_rows", kept=(*MATCH_SIDES, "merged_distinct")),
    "model_id_discrepancies": _stage("model_id_discrepancies"),
    "comparable_terms": _stage("comparable_terms"),
    "class_number_lengths": _stage("class_number_lengths"),
    "unmatched_breakdown": _stage("unmatched_breakdown"),
    "clean_text_load": _clean_text_load,
    "csv_load": _csv_load,
    "octet_load": _octet_load,
    "cleaning_report": _cleaning_report,
    "table_load": _table_load,
    "published_load": _published_load,
    "matched_bucketed": _matched_bucketed,
    "match_counts": _stage("match_counts"),
    "unmatched_breakdown_own": _own_unmatched_breakdown,
    "sql_course_dollars": _sql_course_dollars,
    "sql_class_number_lengths": _sql_class_number_lengths,
    "degree_run_metrics": _degree_run_metrics,
    "refreshed_rates": _refreshed_rates,
    "doctoral_totals_ordered": _positioned("doctoral_totals", ["ssi_payout_y1"]),
    "degree_flag_check_ordered": _positioned("degree_flag_check", ["ssi_payout_y1"]),
    "registrations_by_year": _registrations_by_year,
    "course_payouts_by_fiscal_year": _rates_by_fiscal_year,
    "latest_inventory_cleaned": _latest_inventory_cleaned,
}
