"""Two-part loads: visible together, repeatable, whole when a part fails."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cohortalloc.sinks.publish import POINTER, publish, publish_table, read_published


def frames(spark):
    course = spark.createDataFrame([(1, "a", 1.5), (2, None, None)], "id int, s string, v double")
    doctoral = spark.createDataFrame([(2.5, 3)], "v double, id int")  # other order, one column less
    return course, doctoral


def failing(spark):
    return spark.range(3).select(F.col("id").cast("int").alias("id"), F.raise_error(F.lit("no")).cast("string").alias("s"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


BOTH = [(1, "a", 1.5, "course"), (2, None, None, "course"), (3, None, 2.5, "doctoral")]


@pytest.fixture(params=["folder", "table"])
def target(request, spark):
    """(publish, read, leftovers) for a folder and for a catalog name."""
    if request.param == "folder":
        path = os.path.join(tempfile.mkdtemp(prefix="publish-"), "combined")
        yield (lambda parts, replace=False: publish(spark, path, parts, replace), lambda: read_published(spark, path),
               lambda: [f for f in os.listdir(path) if not f.startswith((".", POINTER))])
    else:
        name = "published_test"
        spark.sql(f"DROP VIEW IF EXISTS {name}")

        def tables():
            return [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__")]

        yield (lambda parts, replace=False: publish_table(spark, name, parts, replace), lambda: spark.table(name), tables)
        spark.sql(f"DROP VIEW IF EXISTS {name}")
        for t in tables():
            spark.sql(f"DROP TABLE {t}")


def test_parts_are_aligned_by_name_and_a_repeated_part_replaces_itself(spark, target):
    load, read, _ = target
    course, doctoral = frames(spark)
    load({"course": course, "doctoral": doctoral}, replace=True)
    assert rows(read()) == BOTH
    load({"doctoral": doctoral})
    load({"doctoral": doctoral})
    assert rows(read()) == BOTH
    load({"course": course.where("id = 1")})
    assert rows(read()) == [BOTH[0], BOTH[2]]
    load({"course": course}, replace=True)  # empties the table first
    assert rows(read()) == BOTH[:2]


def test_a_failure_between_the_parts_leaves_the_old_rows(spark, target):
    load, read, leftovers = target
    course, doctoral = frames(spark)
    load({"course": course, "doctoral": doctoral}, replace=True)
    held = sorted(leftovers())
    with pytest.raises(Exception):
        load({"course": course.limit(1), "doctoral": failing(spark)}, replace=True)
    assert rows(read()) == BOTH
    assert sorted(leftovers()) == held
    with pytest.raises(ValueError, match="lacks"):
        load({"doctoral": doctoral.withColumn("extra", F.lit(1))})
    assert rows(read()) == BOTH


def test_old_parts_go_one_publication_later(spark, target):
    load, read, leftovers = target
    course, _ = frames(spark)
    load({"course": course}, replace=True)
    started = read()  # a reader that began before the next load
    load({"course": course.limit(1)})
    assert started.count() == 2 and read().count() == 1
    load({"course": course.limit(0)})
    assert read().count() == 0 and len(leftovers()) == 2


def test_nothing_published_yet(spark):
    with pytest.raises(FileNotFoundError):
        read_published(spark, tempfile.mkdtemp(prefix="publish-"))
