"""Writing pipeline outputs: CSV export, table create / overwrite / append.

All writers are parallel ``DataFrame.write`` calls: each task writes its own
part file, nothing passes through the driver.  An overwrite first writes the
new rows beside the old ones and switches by renaming once they are
complete: when a load fails, the old rows stay readable.  Errors propagate
to the caller.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortalloc.session import shuffles_removed


def _replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write a new folder beside ``path``, then take its name; the old one goes last."""
    mark = uuid.uuid4().hex
    fresh, old = f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}"
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at, new, before = (jvm.org.apache.hadoop.fs.Path(x) for x in (path, fresh, old))
    fs = at.getFileSystem(conf)
    try:
        write(fresh)
    except Exception:
        fs.delete(new, True)
        raise
    replaced = fs.exists(at)
    if replaced and not fs.rename(at, before):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, at):
        if replaced:
            fs.rename(before, at)
        raise OSError(f"cannot put the new rows at {path}")
    if replaced:
        fs.delete(before, True)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this package has written."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a frame to a folder, which is replaced, and read it back: what stands behind it runs once,
    and its shuffle files are gone before the next step writes its own."""
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV with NULL written as an empty field (a directory of parts).

    Quoting follows RFC 4180, as ``read_csv`` reads it: a field that holds a
    comma, a quote or a line break is quoted, and its quotes are doubled.
    """

    def write(to: str, mode: str = "error") -> None:
        options = {"header": True, "nullValue": "", "emptyValue": "", "quote": '"', "escape": '"'}
        options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}  # blanks are data
        df.write.mode(mode).options(**options).csv(to)

    if mode == "overwrite":
        _replace_folder(df.sparkSession, path, write)
    else:
        write(path, mode)


def create_table(spark: SparkSession, df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Create an empty table with the frame's schema; fails if it exists."""
    df.limit(0).write.format(fmt).mode("error").saveAsTable(table)


def overwrite_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Replace the table's contents with ``df``: loaded into a new table that then takes the name."""
    spark, mark = df.sparkSession, uuid.uuid4().hex
    fresh, old = f"{table}_new_{mark}", f"{table}_old_{mark}"
    try:
        df.write.format(fmt).mode("error").saveAsTable(fresh)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    replaced = spark.catalog.tableExists(table)
    if replaced:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    except Exception:
        if replaced:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    if replaced:
        spark.sql(f"DROP TABLE {old}")


def align_to(df: DataFrame, columns: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """Reorder (and NULL-fill) ``df`` to the target column list by name.

    A load into an existing table is positional; aligning by name first keeps
    a frame with fewer or differently ordered columns from shifting values
    into the wrong columns.
    """
    types = types or {}
    present = set(df.columns)
    cols = []
    for c in columns:
        if c in present:
            col = F.col(c)
            if c in types:
                col = col.cast(types[c])
        else:
            col = F.lit(None).cast(types.get(c, "string"))
        cols.append(col.alias(c))
    return df.select(*cols)


def append_table(spark: SparkSession, df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Append ``df`` to ``table``, aligned to the table's columns by name.

    Columns missing from ``df`` are written as NULL; columns the table does
    not have raise, so no value is silently dropped.
    """
    if not spark.catalog.tableExists(table):
        df.write.format(fmt).mode("error").saveAsTable(table)
        return
    target = spark.table(table).schema
    extra = set(df.columns) - set(target.fieldNames())
    if extra:
        raise ValueError(f"columns not in {table}: {sorted(extra)}")
    aligned = align_to(
        df, target.fieldNames(), {f.name: f.dataType.simpleString() for f in target.fields}
    )
    aligned.write.format(fmt).mode("append").insertInto(table)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Columnar output, optionally partitioned (e.g. by first payout year)."""

    def write(to: str, mode: str = "error") -> None:
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(to)

    if mode == "overwrite":
        _replace_folder(df.sparkSession, path, write)
    else:
        write(path, mode)
