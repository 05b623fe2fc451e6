"""Queries given as SQL files: sources by name, named parameters, a declared result.

The text is Spark SQL.  It names the sources as tables and its parameters as
``:name``; values are bound by Spark, never pasted into the text.  A result is
returned only if it has the declared columns and types, so a changed file
cannot hand shifted columns to what reads it.
"""

from __future__ import annotations

import uuid
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def sql_text(name: str) -> str:
    """The text of one of the package's SQL files."""
    return (resources.files("cohortalloc") / "sql" / f"{name}.sql").read_text(encoding="utf-8")


def run_sql(
    spark: SparkSession,
    text: str,
    sources: dict[str, DataFrame],
    params: dict[str, object] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """The result of ``text`` over ``sources``; its names and types must be those of ``schema``.

    The sources are known by their names in this query alone: no view is left
    in the session, and one of the same name is not touched.
    """
    # Spark replaces {name} by a view of the frame it drops again afterwards; the text names plain tables
    marks = {f"_{name}_{uuid.uuid4().hex}": (name, df) for name, df in sources.items()}
    heads = ",\n".join(f"`{name}` AS (SELECT * FROM {{{mark}}})" for mark, (name, _) in marks.items())
    whole = f"WITH {heads}\nSELECT * FROM (\n{_escaped(text)}\n)" if marks else text
    out = spark.sql(whole, args=params or {}, **{mark: df for mark, (_, df) in marks.items()})
    return out if schema is None else declared(out, schema)


def _escaped(text: str) -> str:
    return text.replace("{", "{{").replace("}", "}}")


def run_sql_file(
    spark: SparkSession,
    path: str,
    sources: dict[str, DataFrame],
    params: dict[str, object] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """As :func:`run_sql`, for a file on any storage Spark reads."""
    text = spark.read.text(path, wholetext=True).first()
    return run_sql(spark, text[0] if text else "", sources, params, schema)


def declared(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` in the schema's column order; raises if names or types differ."""
    found = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in schema.fields}
    wrong = [f"{n}: {found.get(n)} instead of {t}" for n, t in wanted.items() if found.get(n) != t]
    more = sorted(set(found) - set(wanted))
    if wrong or more:
        raise ValueError(f"the query returns other columns than declared: {'; '.join(wrong + more)}")
    return df.select(*schema.fieldNames())
