"""Production run: compute every allocation output and write it.

    python -m cohortalloc.plans.run --tables <root> --institution <code> --out <root>

Reads the ten source tables under ``--tables`` (``<root>/<table>``, parquet
by default), computes the four pipelines, and writes under ``--out``

    course_subsidy, doctoral_subsidy, degree_subsidy, doctoral_degree_subsidy
    combined_course_table     course and doctoral course rows, marked by source
    combined_degree_table     degree and doctoral degree rows, marked by source
    course_reconciliation     allocated vs recognised dollars
    run_metrics               counts and ranges observed while the outputs were written
    audits                    statistics, flag, range and model-id checks

The join of registrations and enrollments feeds every course output and
audit.  It is made once and kept in the cluster's ``spark.checkpoint.dir``
(an executor lost later does not force it to be made again); without that
setting the run refuses to start.

The combined tables are published: both parts become visible together, and a
repeated run replaces its own parts (``cohortalloc.sinks.publish``).  With
``--database`` all outputs are loaded into tables of that database instead of
folders.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortalloc.operators.metrics import ANSWERED, OBSERVED, flag_frame, metrics_frame, observe
from cohortalloc.plans.pipelines import Allocation
from cohortalloc.session import configured_checkpoint_dir
from cohortalloc.sinks.publish import publish, publish_table, union_of_parts
from cohortalloc.sinks.writers import overwrite_table, write_csv, write_parquet
from cohortalloc.sources.lookups import repeated_years
from cohortalloc.sources.readers import load_tables

#: Combined outputs: the frame a table is loaded with, the frame appended, the source marks.
COMBINED = {
    "combined_course_table": ("course_subsidy", "course", "doctoral_subsidy", "doctoral_course"),
    "combined_degree_table": ("degree_subsidy", "degree", "doctoral_degree_subsidy", "doctoral_degree"),
}
AUDITS = (
    "degree_stats",
    "doctoral_degree_stats",
    "degree_flag_check",
    "doctoral_degree_flag_check",
    "rate_range_check",
    "doctoral_minimum_check",
    "models_only_in_dollars",
    "models_only_in_inventory",
    "model_id_discrepancies",
    "unmatched_breakdown",
    "class_number_lengths",
    "repeated_years",
)
OUTPUTS = (
    "course_subsidy",
    "doctoral_subsidy",
    "degree_subsidy",
    "doctoral_degree_subsidy",
    *COMBINED,
    "course_reconciliation",
    *AUDITS,
    "run_metrics",
)


def output(alloc: Allocation, name: str) -> DataFrame:
    """One output frame by name."""
    if name == "models_only_in_dollars":
        return alloc.model_id_set_difference[0]
    if name == "models_only_in_inventory":
        return alloc.model_id_set_difference[1]
    if name == "repeated_years":
        return repeated_years(alloc.src.year_matrix, alloc.src.payout_matrix)
    return getattr(alloc, name)


def run(
    spark: SparkSession,
    alloc: Allocation,
    out_root: str | None,
    fmt: str = "parquet",
    outputs: tuple[str, ...] = OUTPUTS,
    database: str | None = None,
) -> dict[str, str]:
    """Write each requested output under ``out_root`` or into ``database``; returns name -> path or table."""
    if not configured_checkpoint_dir(spark):
        raise ValueError("spark.checkpoint.dir must name a shared folder: the run keeps its shared frames there")
    alloc.keep_shared()
    written: dict[str, str] = {}
    seen: dict[str, dict] = {}  # what was observed while an output was written
    for name in outputs:
        at = f"{database}.{name}" if database else f"{out_root.rstrip('/')}/{name}"
        if name in COMBINED:
            base, mark, more, other = COMBINED[name]
            alloc.keep(base, more)
            parts = {mark: getattr(alloc, base), other: getattr(alloc, more)}
            if database:
                publish_table(spark, at, parts, replace=True, fmt=fmt)
            elif fmt == "csv":
                # one write, one switch: the export has no reader that follows a pointer
                write_csv(union_of_parts(parts), at)
            else:
                publish(spark, at, parts, replace=True)
            written[name] = at
            continue
        watch = None
        if ANSWERED.get(name) in seen:
            frame = flag_frame(spark, seen[ANSWERED[name]], getattr(alloc, ANSWERED[name]))
        elif name == "run_metrics":
            frame = run_metrics(spark, seen)
        else:
            frame = output(alloc, name)
            if name in OBSERVED:
                frame, watch = observe(frame, name)
        if database:
            overwrite_table(frame, at, fmt)
        else:
            (write_csv if fmt == "csv" else write_parquet)(frame, at)
        if watch is not None:
            seen[name] = watch.get
        written[name] = at
    return written


def run_metrics(spark: SparkSession, seen: dict[str, dict]) -> DataFrame:
    """(output, metric, value) of all observed outputs; a few rows each."""
    rows = spark.createDataFrame([], "output string, metric string, value double")
    for name, found in seen.items():
        rows = rows.unionByName(metrics_frame(spark, found).withColumn("output", F.lit(name)))
    return rows


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--tables", required=True, help="root folder of the source tables")
    parser.add_argument("--institution", required=True)
    where = parser.add_mutually_exclusive_group(required=True)
    where.add_argument("--out", help="root folder for the outputs")
    where.add_argument("--database", help="database whose tables are loaded with the outputs")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--source-format", default="parquet")
    parser.add_argument("--year-matrix", default=None, help="CSV replacing the built-in year matrix")
    parser.add_argument("--payout-matrix", default=None, help="CSV replacing the built-in payout matrix")
    parser.add_argument("--overlap", default="literal", choices=["literal", "derived"])
    parser.add_argument("--rate-key", default="acad_year", choices=["acad_year", "fiscal_year"])
    parser.add_argument("--course-recode", action="store_true", help="flag course rows without an amount incomplete")
    parser.add_argument("--times-credit-hours", action="store_true", help="multiply course amounts by credit hours")
    parser.add_argument("--clean-inventory-ids", action="store_true", help="clean model ids of the inventory, too")
    parser.add_argument("--own-unmatched", action="store_true", help="audit the registrations this run leaves unmatched")
    args = parser.parse_args(argv)
    if args.database and args.format == "csv":
        parser.error("tables are loaded as parquet; --format csv needs --out")

    from cohortalloc.session import build_session

    spark = build_session(app="cohortalloc-run")
    sources = load_tables(
        spark, args.tables, args.source_format, args.year_matrix, args.payout_matrix
    )
    alloc = Allocation(
        sources,
        args.institution,
        overlap=args.overlap,
        rate_key=args.rate_key,
        course_recode=args.course_recode,
        times_credit_hours=args.times_credit_hours,
        clean_inventory_ids=args.clean_inventory_ids,
        own_unmatched=args.own_unmatched,
    )
    for name, path in run(spark, alloc, args.out, args.format, database=args.database).items():
        print(f"{name}\t{path}")
    alloc.forget()


if __name__ == "__main__":
    main()
