"""Registrations and enrollments stored so that their match join needs no shuffle.

Both facts are written as tables bucketed and sorted by the three match keys
(and a salt), with the same number of buckets: a later match join merges the
buckets as they lie, for any institution and for every audit.

Skew.  A bucketed join cannot be split at run time, so hot keys are dealt with
when the facts are stored.  Keys held by more than ``HOT_ROWS`` enrollment
rows are hot (at most rows / ``HOT_ROWS`` keys): their enrollment rows are
dealt to ``SALTS`` salts, by a hash of the whole row, and a registration of
such a key is stored once per salt.  Rows without a complete key match
nothing; they get a salt from a hash of the whole row, so that they do not
gather in one bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortalloc.operators.registration import MATCH_KEYS

HOT_ROWS = 1_000_000
SALTS = 32
BUCKETS = 64


def _complete(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _by_row(df: DataFrame, salts: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int")


def hot_keys(eligible: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Match keys held by more than ``hot_rows`` enrollment rows."""
    theirs = [pair[1] for pair in MATCH_KEYS]
    return eligible.where(_complete(theirs)).groupBy(*theirs).count().where(F.col("count") > hot_rows)


def salted_facts(
    passed: DataFrame, eligible: DataFrame, hot_rows: int = HOT_ROWS, salts: int = SALTS, hot: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both facts with ``_salt`` (and ``_hot`` on the registrations); see the module.

    ``hot``: the keys of :func:`hot_keys`, if they are at hand.
    """
    ours, theirs = ([pair[i] for pair in MATCH_KEYS] for i in (0, 1))
    hot = hot_keys(eligible, hot_rows) if hot is None else hot

    def marked(df: DataFrame, keys: list[str]) -> DataFrame:
        known = hot.select(*[F.col(t).alias(f"_{t}") for t in theirs], F.lit(True).alias("_is_hot"))
        cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{t}") for k, t in zip(keys, theirs)])
        joined = df.withColumn("_row_salt", _by_row(df, salts)).join(known, cond, "left")
        return joined.withColumn("_hot", F.col("_is_hot").isNotNull()).drop("_is_hot", *[f"_{t}" for t in theirs])

    enrolled = marked(eligible, theirs)
    spread = F.when(F.col("_hot") | ~_complete(theirs), F.col("_row_salt")).otherwise(F.lit(0))
    enrolled = enrolled.withColumn("_salt", spread).drop("_row_salt", "_hot")
    registered = marked(passed, ours)
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.when(_complete(ours), F.lit(0)).otherwise(F.col("_row_salt")))
    )
    return registered.withColumn("_salt", F.explode(copies)).drop("_row_salt"), enrolled


def store_match_facts(
    spark: SparkSession,
    passed: DataFrame,
    eligible: DataFrame,
    prefix: str,
    path: str | None = None,
    buckets: int = BUCKETS,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> tuple[DataFrame, DataFrame]:
    """Store both facts as ``<prefix>_registrations`` and ``<prefix>_enrollments``, and read them back.

    ``path`` names a folder of the tables on shared storage (default: the
    warehouse).  Tables of that name are replaced.
    """
    ours, theirs = ([pair[i] for pair in MATCH_KEYS] for i in (0, 1))
    out = []
    # both facts are marked by the hot keys: computed once, and so few that their table is broadcast
    hot_keys(eligible, hot_rows).write.mode("overwrite").saveAsTable(f"{prefix}_hot_keys")
    hot = spark.table(f"{prefix}_hot_keys")
    for df, keys, name in zip(
        salted_facts(passed, eligible, hot_rows, salts, hot), (ours, theirs), ("registrations", "enrollments")
    ):
        keys = [*keys, "_salt"]
        # dealt by the bucket keys first: one file per bucket, not one per bucket and task
        writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite")
        if path:
            writer = writer.option("path", f"{path.rstrip('/')}/{prefix}_{name}")
        writer.saveAsTable(f"{prefix}_{name}")
        out.append(spark.table(f"{prefix}_{name}"))
    return out[0], out[1]
