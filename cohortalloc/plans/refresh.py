"""Yearly refresh: per-year hours kept by partition, only changed years computed again.

The cohort rates rest on one small table: students and credit hours per year,
model, course and credit value, under both year bases.  It is kept on shared
storage, partitioned by basis and year.  When registrations of some years
change, only those years' partitions are computed from the registrations and
replaced (dynamic partition overwrite); every fiscal year's rates then follow
from the kept table, whose rows are a tiny fraction of the registrations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortalloc.operators.cohorts import year_type_hours
from cohortalloc.sinks.writers import delete_folder

PARTITIONS = ["aggr_basis", "year"]


def _write(hours: DataFrame, path: str) -> None:
    # one file per year and basis
    dealt = hours.repartition(*PARTITIONS)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(path)


def store_hours(matched: DataFrame, year_matrix: DataFrame, path: str) -> None:
    """Compute and keep the hours of all years the matrix uses."""
    spark = matched.sparkSession
    delete_folder(spark, path)
    _write(year_type_hours(matched, year_matrix), path)


def refresh_hours(matched: DataFrame, year_matrix: DataFrame, path: str, years: list[int]) -> list[str]:
    """Compute the hours of ``years`` again and replace their partitions; returns the partitions left empty.

    A registration counts under its academic and under its calendar year; only
    registrations that have one of ``years`` as either are read.  A year that
    has no registrations any more loses its partition.
    """
    spark = matched.sparkSession
    of_years = F.col("time_academic_yr").isin(years) | F.col("calendar_year").isin(years)
    fresh = year_type_hours(matched.where(of_years), year_matrix).where(F.col("year").isin(years))
    # computed once: the kept table and the list of its years read the same small files
    staged = f"{path.rstrip('/')}_fresh"
    fresh.write.mode("overwrite").parquet(staged)
    fresh = spark.read.schema(fresh.schema).parquet(staged)
    _write(fresh, path)
    held = {tuple(r) for r in read_hours(spark, path, fresh.schema).select(*PARTITIONS).distinct().collect()}
    filled = {tuple(r) for r in fresh.select(*PARTITIONS).distinct().collect()}  # a few per year
    empty = [f"aggr_basis={basis}/year={year}" for basis, year in sorted(held - filled) if year in years]
    for part in empty:
        delete_folder(spark, f"{path}/{part}")
    delete_folder(spark, staged)
    return empty


def read_hours(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The kept hours, with the columns of :func:`year_type_hours`."""
    return spark.read.schema(schema).parquet(path)
