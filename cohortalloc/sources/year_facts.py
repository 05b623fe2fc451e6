"""Registrations kept by academic year, of which a run reads the years its matrices use.

The facts are written partitioned by academic year.  The matrices say which
years matter: an enrollment is paid by its academic year (payout matrix) and
feeds cohorts by its academic or by its calendar year (year matrix).  Those
years, a few numbers from tables of bounded size, become a filter on the
partition column, so the files of all other years are never listed for a scan.

A calendar year ``c`` is taught in the academic years ``c`` (its first half)
and ``c + 1`` (its second half), so both are read for a calendar-basis slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from cohortalloc.operators.cohorts import CALENDAR
from cohortalloc.sources.lookups import cohort_years
from cohortalloc.sources.readers import conform

YEAR = "time_academic_yr"


def years_in_use(year_matrix: DataFrame, payout_matrix: DataFrame) -> list[int]:
    """Academic years whose registrations some fiscal year or payout reads, ascending."""
    slots = cohort_years(year_matrix)
    also = F.when(F.col("year_basis") == CALENDAR, F.col("AY") + 1).otherwise(F.col("AY"))
    years = slots.select(F.explode(F.array("AY", also)).alias("year")).unionByName(payout_matrix.select("year"))
    return sorted(r["year"] for r in years.where("year is not null").distinct().collect())  # bounded by the matrices


def write_by_year(registrations: DataFrame, path: str) -> None:
    """Write registrations partitioned by academic year; a missing year has a partition of its own."""
    registrations.withColumn(YEAR, F.col(YEAR).cast("int")).write.mode("overwrite").partitionBy(YEAR).parquet(path)


def read_by_year(spark: SparkSession, path: str, schema: StructType, years: list[int]) -> DataFrame:
    """The registrations of ``years``, typed by ``schema``; other years' files are not read.

    Registrations without an academic year stay: they still have a calendar year.
    """
    stored = StructType([StructField(f.name, IntegerType() if f.name == YEAR else f.dataType, True) for f in schema.fields])
    rows = spark.read.schema(stored).parquet(path)
    return conform(rows.where(F.col(YEAR).isin(years) | F.col(YEAR).isNull()), schema)
