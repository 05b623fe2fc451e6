"""Source readers: parquet / CSV / JDBC tables cast once to the package schemas,
plus the load-time text cleaning the warehouse applied on COPY."""

from __future__ import annotations

from dataclasses import dataclass, fields
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

from cohortalloc.sources import schemas
from cohortalloc.sources.lookups import read_payout_matrix, read_year_matrix


def _same_value(col: Column, cast: Column, source: DataType, target: DataType) -> Column:
    """Whether a cast kept the value: numbers by value, everything else by its way back."""
    if isinstance(target, NumericType) and isinstance(source, (NumericType, StringType)):
        exact = "decimal(38,18)"
        if isinstance(target, (DoubleType, FloatType)):
            if isinstance(source, (IntegralType, DecimalType)):
                return cast.try_cast("decimal(38,18)" if isinstance(source, DecimalType) else source) == col
            return cast.isNotNull()  # any other number has a double; unparsable text has none
        return col.try_cast(exact) == cast.try_cast(exact)
    return cast.try_cast(source) == col


def conform(df: DataFrame, schema: StructType, lenient: bool = False) -> DataFrame:
    """Select exactly the schema's columns, cast to its types.

    A cast that would change a value (a fraction cut off, text that is no
    number) raises, so that nothing is silently lost; ``lenient=True`` turns
    such values into NULL instead.
    """
    cols = []
    for field in schema.fields:
        col, source = F.col(field.name), df.schema[field.name].dataType
        if source != field.dataType:
            cast = col.try_cast(field.dataType)
            if not isinstance(field.dataType, StringType):
                lost = col.isNotNull() & ~F.coalesce(_same_value(col, cast, source, field.dataType), F.lit(False))
                if lenient:
                    cast = F.when(~lost, cast)
                else:
                    said = F.concat(F.lit(f"{field.name}: cannot keep as {field.dataType.simpleString()}: "), col.cast("string"))
                    cast = F.when(lost, F.raise_error(said).cast(field.dataType)).otherwise(cast)
            col = cast
        cols.append(col.alias(field.name))
    return df.select(*cols)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return conform(df, schema) if schema is not None else df


#: RFC 4180: a quote inside a quoted field is doubled, and the field may hold line breaks
CSV_DIALECT = {"quote": '"', "escape": '"'}


def csv_header(spark: SparkSession, path: str, multi_line: bool = True) -> list[str]:
    """Column names of a header CSV (a file or a folder of parts), without a byte-order mark."""
    reader = spark.read.options(header=True, multiLine=multi_line, **CSV_DIALECT)
    return [name.lstrip("\ufeff") for name in reader.csv(path).columns]


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    widths: dict[str, int] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Header CSV: every field read as text, cleaned (:func:`clean_text`), then cast.

    Fields are bound by the names in the header, in whatever order the file
    has them; columns the schema does not name are not kept, and one that the
    file lacks raises.  Parts whose header differs from the others' raise when
    they are read.  Quoting follows RFC 4180.  No inference pass; blank lines
    are skipped.  The text ``NULL`` alone is NULL; with blanks before it, it
    is text.  ``widths`` are octets.

    A quoted field may hold line breaks, so a file is read by one task (the
    parts of a folder in parallel); ``multi_line=False`` splits large files
    that are known to have none.
    """
    names = csv_header(spark, path, multi_line)
    lacking = [f.name for f in schema.fields if f.name not in names]
    if lacking:
        raise ValueError(f"{path} has no column {', '.join(lacking)}; its header: {', '.join(names)}")
    texts = StructType([StructField(name, StringType(), True) for name in names])
    options = {"header": True, "mode": "FAILFAST", "enforceSchema": False, "multiLine": multi_line}
    raw = spark.read.options(**options, **CSV_DIALECT).schema(texts).csv(path)
    return conform(clean_strings(raw.select(*schema.fieldNames()), widths), schema)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    schema: StructType,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Warehouse table over JDBC; a numeric ``partition_column`` splits the
    read into ``num_partitions`` parallel range queries."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower_bound)
            .option("upperBound", upper_bound)
            .option("numPartitions", num_partitions)
        )
    return conform(reader.load(), schema)


def cut_to_octets(col: Column, width: int) -> Column:
    """The longest beginning of a text that takes at most ``width`` octets in UTF-8.

    A character that would cross the limit is dropped whole: if the byte
    behind the limit continues a character (10xxxxxx), the cut moves back to
    where that character begins.
    """
    octets = F.encode(col, "utf-8")
    kept = F.substring(octets, 1, width)
    # the byte behind the limit and the three before it: one of them begins a character
    byte = lambda back: F.conv(F.hex(F.substring(octets, width + 1 - back, 1)), 16, 10).cast("int")
    begins = lambda back: byte(back).bitwiseAND(F.lit(0xC0)) != 0x80
    whole = F.when(begins(0), kept)
    for back in (1, 2, 3):
        whole = whole.when(begins(back), F.substring(octets, 1, width - back))
    return F.when(F.octet_length(col) <= width, col).otherwise(F.decode(whole, "utf-8"))


def clean_text(col: Column, width: int | None = None, null_text: str = "NULL") -> Column:
    """Load-time cleaning of one text column.

    The field text ``NULL`` becomes NULL, trailing blanks are trimmed, a blank
    field becomes NULL, invalid UTF-8 is replaced, and an over-long value is
    cut to ``width`` octets of UTF-8, never within a character.
    """
    valid = F.make_valid_utf8(col)
    trimmed = F.rtrim(valid)
    out = F.when((valid == F.lit(null_text)) | (trimmed == F.lit("")), F.lit(None)).otherwise(
        trimmed
    )
    return out if width is None else cut_to_octets(out, width)


def clean_strings(df: DataFrame, widths: dict[str, int] | None = None) -> DataFrame:
    """Apply :func:`clean_text` to every string column (one projection)."""
    widths = widths or {}
    return df.withColumns(
        {
            f.name: clean_text(F.col(f.name), widths.get(f.name))
            for f in df.schema.fields
            if isinstance(f.dataType, StringType)
        }
    )


def cleaning_report(df: DataFrame, widths: dict[str, int] | None = None) -> DataFrame:
    """(column, n_values, n_nulled, n_cut, n_replaced): what :func:`clean_strings` does to ``df``.

    ``n_nulled`` counts texts that become NULL, ``n_cut`` texts over their
    width after trimming, ``n_replaced`` texts with invalid UTF-8.  One pass
    over the rows, one aggregate for all columns.
    """
    widths = widths or {}
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    counts = []
    for i, name in enumerate(names):
        col = F.col(f"`{name}`")
        whole, width = clean_text(col), widths.get(name)
        counts += [
            F.count(col).alias(f"n_values_{i}"),
            F.count_if(col.isNotNull() & whole.isNull()).alias(f"n_nulled_{i}"),
            (F.count_if(F.octet_length(whole) > width) if width is not None else F.lit(0).cast("long")).alias(f"n_cut_{i}"),
            F.count_if(~F.is_valid_utf8(col)).alias(f"n_replaced_{i}"),
        ]
    measures = ("n_values", "n_nulled", "n_cut", "n_replaced")
    rows = [
        F.struct(F.lit(name).alias("column"), *[F.col(f"{m}_{i}").alias(m) for m in measures])
        for i, name in enumerate(names)
    ]
    return df.agg(*counts).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


class SourceTables(Protocol):
    """What the pipelines read: ten tables and two yearly lookups.

    Satisfied by :class:`Sources` (eager bundle) and by the lazy fixture
    views, whose plans are built only when a stage asks for them.
    """

    registrations: DataFrame
    enrollments: DataFrame
    term_lookup: DataFrame
    course_allocations: DataFrame
    doctoral_subsidy: DataFrame
    completions: DataFrame
    acad_plans: DataFrame
    degree_allocations: DataFrame
    course_inventory: DataFrame
    unmatched: DataFrame
    year_matrix: DataFrame
    payout_matrix: DataFrame


@dataclass
class Sources:
    """The ten warehouse tables plus the two yearly lookups, as DataFrames."""

    registrations: DataFrame
    enrollments: DataFrame
    term_lookup: DataFrame
    course_allocations: DataFrame
    doctoral_subsidy: DataFrame
    completions: DataFrame
    acad_plans: DataFrame
    degree_allocations: DataFrame
    course_inventory: DataFrame
    unmatched: DataFrame
    year_matrix: DataFrame
    payout_matrix: DataFrame

    def table_names(self) -> list[str]:
        return [f.name for f in fields(self)]


def load_tables(
    spark: SparkSession,
    root: str,
    fmt: str = "parquet",
    year_matrix_path: str | None = None,
    payout_matrix_path: str | None = None,
) -> Sources:
    """Read ``<root>/<table>`` for every source table, typed by :mod:`schemas`."""
    tables = {}
    for name, schema in schemas.SOURCES.items():
        path = f"{root}/{name}"
        if fmt == "csv":
            tables[name] = read_csv(spark, path, schema)
        elif fmt == "jdbc":  # ``root`` is the connection URL
            tables[name] = read_jdbc(spark, root, name, schema)
        else:
            tables[name] = conform(spark.read.format(fmt).load(path), schema)
    return Sources(
        **tables,
        year_matrix=read_year_matrix(spark, year_matrix_path),
        payout_matrix=read_payout_matrix(spark, payout_matrix_path),
    )
