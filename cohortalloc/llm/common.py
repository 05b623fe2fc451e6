"""Helpers shared by the operators: tables, shared storage, ordered ranges."""

from __future__ import annotations

import contextlib
import math
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the standard tables, read through Spark (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> SparkSession:
    """Make this package importable in the executors' Python workers (once per context)."""
    sc = spark.sparkContext
    if not getattr(sc, "_llm_shipped", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        base = os.path.join(tempfile.mkdtemp(prefix="llm-package-"), "package")
        root, name = os.path.split(package)
        sc.addPyFile(shutil.make_archive(base, "zip", root, name))
        sc._llm_shipped = True
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session (tests) may run without the setting; it then gets a
    temporary folder of its own.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="llm-shared-")
        sc.setCheckpointDir(path)
    return path


def materialise(df: DataFrame, name: str, row_group: int = 0) -> DataFrame:
    """Write ``df`` to shared storage and read it back: cuts lineage.

    The files survive the loss of any executor, and what stands behind them
    is computed once however often the result is read.  ``row_group``: bytes
    that a writer holds, and a reader loads, at once; for rows of megabytes,
    of which Parquet otherwise holds 100 before it looks at their size.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if row_group:
        writer = writer.options(**{
            "parquet.block.size": row_group, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1,
            "parquet.page.size.row.check.min": 1,
        })
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, size: int):
    """What runs inside moves to and from Python in batches of about ``size`` bytes at most."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) if before[:1] != "-" else 0
    spark.conf.set(key, str(min(now, size) if now > 0 else size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def runs_of_texts(column, chars: int = 1 << 20):
    """The texts of an Arrow column (NULL: empty) in lists of about ``chars`` code points."""
    held, size = [], 0
    for at in range(0, len(column), 128):  # not all of a batch as Python text at once
        for text in column.slice(at, 128).to_pylist():
            held.append(text or "")
            size += len(held[-1])
            if size >= chars:
                yield held
                held, size = [], 0
    if held:
        yield held


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_bounds(df: DataFrame, key: str, parts: int) -> list[int]:
    """First keys of at most ``parts`` consecutive ranges of about equal size.

    Every bound is a key of the data, the first one is the smallest key, and
    the list holds at most ``parts`` numbers whatever the size of the data.
    Empty for a table without a key.
    """
    fractions = [i / parts for i in range(parts)]
    row = df.agg(
        F.min(key).alias("low"),
        F.percentile_approx(key, fractions, max(10_000, 20 * parts)).alias("cuts"),
    ).first()
    return [] if row["low"] is None else sorted({row["low"], *row["cuts"]})


def range_of(key: Column, bounds: list[int]) -> Column:
    """Index of the range of ``id_bounds`` that holds ``key`` (NULL: range 0).

    Two short scans (coarse, then fine) instead of one over all bounds.
    """
    if not bounds:
        return F.lit(0)
    width = max(1, math.isqrt(len(bounds)))
    blocks = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    long_array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    firsts = long_array([b[0] for b in blocks])
    rows = F.array(*[long_array(b) for b in blocks])
    below = lambda xs: F.size(F.filter(xs, lambda b: b <= key))
    block = F.greatest(below(firsts) - 1, F.lit(0))
    inside = below(F.element_at(rows, block + 1))
    return F.greatest(block * width + inside - 1, F.lit(0)).cast("int")
