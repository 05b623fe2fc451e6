"""Round trips through the writers."""

import os
import tempfile

from cohortalloc.sinks import append_table, create_table, overwrite_table, write_csv


def test_csv_writes_null_as_empty(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="csv-"), "out")
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    write_csv(df, d)
    text = "".join(open(os.path.join(d, f)).read() for f in sorted(os.listdir(d)) if f.endswith(".csv"))
    lines = [l for l in text.splitlines() if l and l != "id,s"]
    assert sorted(lines) == ["1,a", "2,"]


def test_create_overwrite_append_by_name(spark):
    wh = tempfile.mkdtemp(prefix="wh-")
    table = "sink_test_tbl"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    full = spark.createDataFrame([(1, "a", 1.5)], "id int, s string, v double")
    spark.sql(f"CREATE TABLE {table} (id int, s string, v double) USING parquet LOCATION '{wh}/t'")
    overwrite_table(full, table)
    # fewer columns, other order: aligned by name, missing column NULL
    part = spark.createDataFrame([(2.5, 2)], "v double, id int")
    append_table(spark, part, table)
    got = sorted(tuple(r) for r in spark.table(table).collect())
    assert got == [(1, "a", 1.5), (2, None, 2.5)]
    overwrite_table(part.select("id", "v").withColumn("s", part.v.cast("string")).select("id", "s", "v"), table)
    assert spark.table(table).count() == 1
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_create_table_fails_if_exists(spark):
    import pytest

    wh = tempfile.mkdtemp(prefix="wh-")
    table = "sink_create_tbl"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    df = spark.createDataFrame([(1,)], "id int")
    spark.conf.set("spark.sql.legacy.allowNonEmptyLocationInCTAS", "true")
    spark.sql(f"CREATE TABLE {table} (id int) USING parquet LOCATION '{wh}/t'")
    with pytest.raises(Exception):
        create_table(spark, df, table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_append_rejects_unknown_columns(spark):
    import pytest

    wh = tempfile.mkdtemp(prefix="wh-")
    table = "sink_extra_tbl"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} (id int) USING parquet LOCATION '{wh}/t'")
    with pytest.raises(ValueError):
        append_table(spark, spark.createDataFrame([(1, "x")], "id int, extra string"), table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def _failing(spark):
    from pyspark.sql import functions as F

    return spark.range(4).select(F.col("id").cast("int").alias("id"), F.raise_error(F.lit("no")).cast("string").alias("s"))


def test_a_failing_overwrite_keeps_the_old_rows(spark):
    import pytest

    from cohortalloc.sinks import write_parquet

    good = spark.createDataFrame([(1, "a")], "id int, s string")
    root = tempfile.mkdtemp(prefix="keep-")
    table = "sink_keep_tbl"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    overwrite_table(good, table)
    write_parquet(good, f"{root}/p")
    write_csv(good, f"{root}/c")
    for load in (
        lambda: overwrite_table(_failing(spark), table),
        lambda: write_parquet(_failing(spark), f"{root}/p"),
        lambda: write_csv(_failing(spark), f"{root}/c"),
    ):
        with pytest.raises(Exception):
            load()
    assert [tuple(r) for r in spark.table(table).collect()] == [(1, "a")]
    assert [tuple(r) for r in spark.read.parquet(f"{root}/p").collect()] == [(1, "a")]
    assert [tuple(r) for r in spark.read.csv(f"{root}/c", header=True).collect()] == [("1", "a")]
    assert sorted(os.listdir(root)) == ["c", "p"]
    write_parquet(good.unionAll(good), f"{root}/p")
    assert spark.read.parquet(f"{root}/p").count() == 2
    spark.sql(f"DROP TABLE {table}")
