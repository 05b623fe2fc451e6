"""Checks taken while an output is written: observed metrics instead of another pass.

``observe`` adds aggregates to a frame that is about to be written; Spark
computes them in the tasks that write it.  What such metrics can say (row and
NULL counts, ranges, the years and flags that occur) needs no job of its own;
per-group statistics still do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortalloc.operators.degrees import TOTAL_COLUMN
from cohortalloc.operators.payouts import COURSE_AMOUNTS, PAYOUT_YEARS

METRICS_SCHEMA = "metric string, value double"
FLAG_COLUMNS = ["degree_ocurred", *PAYOUT_YEARS, "complete_flag"]


def _range(name: str) -> list[Column]:
    col = F.col(name)
    return [
        F.count(col).cast("double").alias(f"known_{name}"), F.min(col).cast("double").alias(f"min_{name}"),
        F.max(col).cast("double").alias(f"max_{name}"),
    ]


def _complete() -> Column:
    return F.count_if(F.col("complete_flag") == "complete").cast("double").alias("n_complete")


def course_metrics() -> list[Column]:
    """Rows, complete rows, and count and range of each payout year's amounts."""
    out = [F.count(F.lit(1)).cast("double").alias("n_rows"), _complete()]
    for name in (*COURSE_AMOUNTS, "ssi_total_all_three_years_combined"):
        out += _range(name)
    return out


def degree_metrics() -> list[Column]:
    """Rows, complete rows, count and range of the totals, and the (year, flag) combinations.

    The combinations are bounded by the calendar: a few per academic year.
    """
    flags = F.collect_set(F.struct(*FLAG_COLUMNS)).alias("flags")
    return [F.count(F.lit(1)).cast("double").alias("n_rows"), _complete(), *_range(TOTAL_COLUMN), flags]


#: Outputs whose writing is observed.
OBSERVED = {
    "course_subsidy": course_metrics,
    "doctoral_subsidy": course_metrics,
    "degree_subsidy": degree_metrics,
    "doctoral_degree_subsidy": degree_metrics,
}
#: Audits that the metrics of an output answer.
ANSWERED = {"degree_flag_check": "degree_subsidy", "doctoral_degree_flag_check": "doctoral_degree_subsidy"}


def observe(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with the metrics of output ``name``; the observation has them once ``df`` is written."""
    seen = Observation(name)
    return df.observe(seen, *OBSERVED[name]()), seen


def metrics_frame(spark: SparkSession, seen: dict) -> DataFrame:
    """(metric, value) of an observation's plain numbers."""
    rows = [(k, None if v is None else float(v)) for k, v in seen.items() if k != "flags"]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def flag_frame(spark: SparkSession, seen: dict, like: DataFrame) -> DataFrame:
    """The distinct (year, payout years, flag) rows of an observed degree output."""
    rows = [tuple(r[c] for c in FLAG_COLUMNS) for r in seen["flags"]]
    return spark.createDataFrame(rows, like.select(*FLAG_COLUMNS).schema)
