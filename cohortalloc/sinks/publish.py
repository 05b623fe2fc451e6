"""Loads of several parts that become visible together and can be repeated.

An output such as the combined course table is loaded in two parts: the table
is emptied and loaded with the course rows, then the doctoral rows are
appended.  Readers must never see half of it, and a repeated append must not
double its rows.  Both follow from two rules: a part is written beside the
current ones under a new name and never changed, and one atomic step makes a
new set of parts the current one.

Folders.  ``publish`` writes each part to ``<path>/<part>-<id>`` and then
replaces ``<path>/_CURRENT``, a small text file that names the folder of every
part (one atomic rename; on an object store one put).  ``read_published``
reads what the file names.

Tables.  ``publish_table`` writes each part as a table and then replaces the
view of the published name (one change in the metastore).

A part is identified by its name, which readers get as the column ``source``:
publishing a part again replaces its rows; the other parts stay.  Folders and
tables that the switch leaves behind are kept until the next publication, so
that readers that have begun can finish.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POINTER = "_CURRENT"
SOURCE = "source"


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _read_pointer(spark: SparkSession, path: str) -> dict:
    """What is published under ``path``: {"parts": {name: folder}, "schema": ..., "left": [folders]}."""
    at, fs = _file_system(spark, f"{path}/{POINTER}")
    if not fs.exists(at):
        return {"parts": {}, "schema": None, "left": []}
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _write_pointer(spark: SparkSession, path: str, state: dict) -> None:
    """Replace the pointer file in one step."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fresh, fs = _file_system(spark, f"{path}/{POINTER}-{uuid.uuid4().hex}")
    stream = fs.create(fresh, True)
    try:
        stream.write(bytearray(json.dumps(state).encode()))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    final = jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), conf).rename(fresh, final, how)


def aligned(parts: dict[str, DataFrame], schema: StructType) -> dict[str, DataFrame]:
    """The parts with the schema's columns by name: lacking ones NULL, unknown ones an error."""
    out = {}
    for name, df in parts.items():
        unknown = sorted(set(df.columns) - set(schema.fieldNames()))
        if unknown:
            raise ValueError(f"part {name} has columns the table lacks: {unknown}")
        own = set(df.columns)
        out[name] = df.select(*[
            (F.col(f"`{f.name}`") if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
        ])
    return out


def union_of_parts(parts: dict[str, DataFrame]) -> DataFrame:
    """The parts as one frame with the first one's columns and ``source``."""
    marked = [df.withColumn(SOURCE, F.lit(name)) for name, df in aligned(parts, _schema_of(parts, None)).items()]
    return reduce(DataFrame.unionByName, marked)


def _schema_of(parts: dict[str, DataFrame], held: str | None) -> StructType:
    """Schema of the published table, else that of the first part."""
    return StructType.fromJson(json.loads(held)) if held else next(iter(parts.values())).schema


def publish(spark: SparkSession, path: str, parts: dict[str, DataFrame], replace: bool = False) -> None:
    """Write ``parts`` under ``path`` and make them current in one step.

    ``replace=True`` drops all parts not named here (empty the table, then
    load); otherwise they stay as they are.  Nothing changes for readers, and
    no folder is left, if a part fails.
    """
    path = path.rstrip("/")
    before = _read_pointer(spark, path)
    schema = _schema_of(parts, None if replace else before["schema"])
    made: dict[str, str] = {}
    try:
        for name, df in aligned(parts, schema).items():
            made[name] = f"{name}-{uuid.uuid4().hex}"
            df.write.mode("error").parquet(f"{path}/{made[name]}")
        current = made if replace else before["parts"] | made
        left = [folder for folder in before["parts"].values() if folder not in current.values()]
        _write_pointer(spark, path, {"parts": current, "schema": schema.json(), "left": left})
    except Exception:
        _delete(spark, path, made.values())
        raise
    _delete(spark, path, before["left"])


def _delete(spark: SparkSession, path: str, folders) -> None:
    for folder in folders:
        at, fs = _file_system(spark, f"{path}/{folder}")
        fs.delete(at, True)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The current rows under ``path`` with their part's name as ``source``."""
    path = path.rstrip("/")
    state = _read_pointer(spark, path)
    if not state["parts"]:
        raise FileNotFoundError(f"nothing is published at {path}")
    schema = StructType.fromJson(json.loads(state["schema"]))
    parts = [
        spark.read.schema(schema).parquet(f"{path}/{folder}").withColumn(SOURCE, F.lit(name))
        for name, folder in state["parts"].items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- named tables -----------------------------------------------------------------


def _table_parts(spark: SparkSession, name: str) -> dict:
    """The published view's state, which it carries as its comment."""
    if not spark.catalog.tableExists(name):
        return {"parts": {}, "schema": None, "left": []}
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Comment'").collect()
    if not rows:
        raise ValueError(f"{name} exists and is no published table")
    return json.loads(rows[0]["data_type"])


def publish_table(spark: SparkSession, name: str, parts: dict[str, DataFrame], replace: bool = False, fmt: str = "parquet") -> None:
    """As :func:`publish`, for a name in the catalog: a view over one table per part."""
    before = _table_parts(spark, name)
    held = spark.table(name).drop(SOURCE).schema if before["parts"] and not replace else None
    schema = held or next(iter(parts.values())).schema
    made: dict[str, str] = {}
    try:
        for part, df in aligned(parts, schema).items():
            made[part] = f"{name}__{part}_{uuid.uuid4().hex}"
            df.write.format(fmt).mode("error").saveAsTable(made[part])
        current = made if replace else before["parts"] | made
        left = [table for table in before["parts"].values() if table not in current.values()]
        columns = ", ".join(f"`{c}`" for c in schema.fieldNames())
        rows = " UNION ALL ".join(f"SELECT {columns}, '{part}' AS {SOURCE} FROM {table}" for part, table in current.items())
        state = json.dumps({"parts": current, "left": left}).replace("'", "\\'")
        spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT '{state}' AS {rows}")
    except Exception:
        _drop(spark, made.values())
        raise
    _drop(spark, before["left"])


def _drop(spark: SparkSession, tables) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
