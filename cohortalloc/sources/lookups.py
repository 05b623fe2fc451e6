"""The two yearly lookup tables: cohort year matrix and payout-year matrix.

Both are configuration (one row per fiscal / academic year), not facts, so
their size is bounded by the calendar: they are the only frames this package
broadcasts unconditionally.  A deployment may keep them as CSV files on
shared storage (``read_year_matrix(path=...)``); without a path the built-in
values below are used.
"""

from __future__ import annotations

import csv
import io
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortalloc.sources.schemas import PAYOUT_MATRIX, YEAR_MATRIX

# --- Fixed values (must equal the published allocation rules) ---------------
# Year matrix: FY, AY_1, AY_2, AY_3, status, year_basis, year_gap.
# The fiscal year FY is paid from the three listed years; the status says
# whether that FY's figures are final; year_basis says whether the years are
# academic ("fiscal") or calendar years.
YEAR_MATRIX_ROWS = [
    (2013, 2012, 2011, 2010, "incomplete", "fiscal", 1),
    (2014, 2013, 2012, 2011, "incomplete", "fiscal", 1),
    (2015, 2014, 2013, 2012, "incomplete", "fiscal", 1),
    (2016, 2015, 2014, 2013, "complete", "fiscal", 1),
    (2017, 2016, 2015, 2014, "complete", "fiscal", 1),
    (2018, 2017, 2016, 2015, "complete", "fiscal", 1),
    (2019, 2018, 2017, 2016, "complete", "fiscal", 1),
    (2020, 2019, 2018, 2017, "complete", "fiscal", 1),
    (2021, 2020, 2019, 2018, "complete", "fiscal", 1),
    (2022, 2020, 2019, 2018, "complete", "fiscal", 2),
    (2023, 2021, 2020, 2019, "complete", "calendar", 2),
    (2024, 2022, 2021, 2020, "complete", "calendar", 2),
    (2025, 2023, 2022, 2021, "incomplete", "calendar", 2),
    (2026, 2024, 2023, 2022, "incomplete", "calendar", 2),
    (2027, 2025, 2024, 2023, "incomplete", "calendar", 2),
    (2028, 2026, 2025, 2024, "incomplete", "calendar", 2),
    (2029, 2027, 2026, 2025, "incomplete", "calendar", 2),
    (2030, 2028, 2027, 2026, "incomplete", "calendar", 2),
    (2031, 2029, 2028, 2027, "incomplete", "calendar", 2),
    (2032, 2030, 2029, 2028, "incomplete", "calendar", 2),
    (2033, 2031, 2030, 2029, "incomplete", "calendar", 2),
    (2034, 2032, 2031, 2030, "incomplete", "calendar", 2),
    (2035, 2033, 2032, 2031, "incomplete", "calendar", 2),
]

# Payout matrix: year, ssi_payout_y1, ssi_payout_y2, ssi_payout_y3, gap,
# year_basis.  An enrollment of academic year `year` is paid in the three
# listed fiscal years.
PAYOUT_MATRIX_ROWS = [
    (2013, 2014, 2015, 2016, 1, "fiscal"),
    (2014, 2015, 2016, 2017, 1, "fiscal"),
    (2015, 2016, 2017, 2018, 1, "fiscal"),
    (2016, 2017, 2018, 2019, 1, "fiscal"),
    (2017, 2018, 2019, 2020, 1, "fiscal"),
    (2018, 2019, 2020, 2021, 1, "fiscal"),
    (2019, 2020, 2021, 2022, 1, "fiscal"),
    (2020, 2021, 2022, 2023, 1, "fiscal"),
    (2021, 2023, 2024, 2025, 2, "calendar"),
    (2022, 2024, 2025, 2026, 2, "calendar"),
    (2023, 2025, 2026, 2027, 2, "calendar"),
    (2024, 2026, 2027, 2028, 2, "calendar"),
    (2025, 2027, 2028, 2029, 2, "calendar"),
    (2026, 2028, 2029, 2030, 2, "calendar"),
    (2027, 2029, 2030, 2031, 2, "calendar"),
    (2028, 2030, 2031, 2032, 2, "calendar"),
    (2029, 2031, 2032, 2033, 2, "calendar"),
    (2030, 2032, 2033, 2034, 2, "calendar"),
]

# Academic years whose per-year rate is scaled by 3/4 in the course pipeline
# because they feed four fiscal years instead of three.
OVERLAP_YEARS = (2018, 2019, 2020)
# -----------------------------------------------------------------------------

#: Lookups are broadcast; a file larger than this is no yearly lookup and is refused.
LOOKUP_BYTES = 1 << 20


def _csv_frame(spark: SparkSession, path: str, schema) -> DataFrame:
    """A lookup table from a header CSV (a UTF-8 byte-order mark is dropped), bound by column name.

    Read lazily; :func:`repeated_years` tells whether a year has several rows.
    The file's size is checked, since every lookup is broadcast.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    if size > LOOKUP_BYTES:
        raise ValueError(f"{path} has {size} bytes; a yearly lookup has at most {LOOKUP_BYTES}")
    from cohortalloc.sources.readers import read_csv

    return read_csv(spark, path, schema)


def repeated_years(year_matrix: DataFrame, payout_matrix: DataFrame) -> DataFrame:
    """(lookup, year, n_rows) of years that have several rows in a lookup; none in a sound one."""
    found = [
        df.groupBy(F.col(key).alias("year")).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
        .select(F.lit(name).alias("lookup"), "year", "n_rows")
        for name, df, key in (("year_matrix", year_matrix, "FY"), ("payout_matrix", payout_matrix, "year"))
    ]
    return found[0].unionByName(found[1])


def _sql_literal(v) -> str:
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def _local_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A JVM-side local relation (SQL VALUES): no Python worker is involved
    when it is scanned, and Catalyst can fold filters over it."""
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    names = ", ".join(schema.fieldNames())
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_year_matrix(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Wide year matrix (23 rows built in); ``path`` reads a CSV instead."""
    if path:
        return _csv_frame(spark, path, YEAR_MATRIX)
    return _local_table(spark, YEAR_MATRIX_ROWS, YEAR_MATRIX)


def read_payout_matrix(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Payout matrix (18 rows built in); ``path`` reads a CSV (BOM tolerated)."""
    if path:
        return _csv_frame(spark, path, PAYOUT_MATRIX)
    return _local_table(spark, PAYOUT_MATRIX_ROWS, PAYOUT_MATRIX)


def matrix_csv_text(rows, schema, bom: bool = False) -> str:
    """Render a lookup table as CSV text (used by tests and exports)."""
    buf = io.StringIO()
    writer = csv.writer(buf, lineterminator="\n")
    writer.writerow(schema.fieldNames())
    writer.writerows(rows)
    return ("﻿" if bom else "") + buf.getvalue()


def status_by_fiscal_year(year_matrix: DataFrame) -> DataFrame:
    """Distinct (FY, status): the completeness of each fiscal year."""
    return year_matrix.select("FY", "status").distinct()


_COHORTS: "weakref.WeakKeyDictionary[DataFrame, DataFrame]" = weakref.WeakKeyDictionary()


def cohort_years(year_matrix: DataFrame) -> DataFrame:
    """Unpivot the year matrix to one row per (FY, contributing year).

    ``years_included`` keeps the matrix order of the three years
    (``"2012,2011,2010"``); it is built before unpivoting so that no ordered
    collection is needed afterwards.  The frame is built once per matrix.
    """
    cached = _COHORTS.get(year_matrix)
    if cached is None:
        cached = _COHORTS[year_matrix] = _unpivot_matrix(year_matrix)
    return cached


def _unpivot_matrix(year_matrix: DataFrame) -> DataFrame:
    with_list = year_matrix.withColumn(
        "years_included",
        F.concat_ws(",", *[F.col(c).cast("string") for c in ("AY_1", "AY_2", "AY_3")]),
    )
    return with_list.unpivot(
        ["FY", "status", "year_basis", "year_gap", "years_included"],
        ["AY_1", "AY_2", "AY_3"],
        "name",
        "AY",
    )
