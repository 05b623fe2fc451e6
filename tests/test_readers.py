"""Source readers: casts that keep every value, CSV cleaned before it is cast."""

import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, StringType, StructField, StructType

from cohortalloc.operators.registration import passed_registrations
from cohortalloc.sources import schemas
from cohortalloc.sources.lookups import repeated_years, read_payout_matrix, read_year_matrix
from cohortalloc.sources.readers import cleaning_report, conform, cut_to_octets, read_csv


def test_conform_casts_and_rejects_bad_text(spark):
    schema = StructType([StructField("y", IntegerType()), StructField("s", StringType())])
    df = spark.createDataFrame([("2020", "a")], "y string, s string")
    assert conform(df, schema).first().y == 2020
    bad = spark.createDataFrame([("20x0", "a")], "y string, s string")
    with pytest.raises(Exception):
        conform(bad, schema).collect()
    assert conform(bad, schema, lenient=True).first().y is None


@pytest.mark.parametrize("value,kind", [(1.5, "double"), ("1.5", "string"), (2**40, "long")])
def test_conform_refuses_a_lossy_cast(spark, value, kind):
    schema = StructType([StructField("n", IntegerType())])
    df = spark.createDataFrame([(value,), (None,)], f"n {kind}")
    with pytest.raises(Exception, match="cannot keep"):
        conform(df, schema).collect()
    assert [r.n for r in conform(df, schema, lenient=True).collect()] == [None, None]


def test_conform_keeps_fractions_and_leading_zeros(spark):
    schema = StructType([StructField("h", DecimalType(9, 2)), StructField("id", StringType())])
    df = spark.createDataFrame([(0.5, "00123"), (3.0, "P9"), (None, None)], "h double, id string")
    assert [tuple(r) for r in conform(df, schema).collect()] == [
        (Decimal("0.50"), "00123"), (Decimal("3.00"), "P9"), (None, None)
    ]


def test_half_hours_survive_the_reader(spark):
    row = {f.name: None for f in schemas.REGISTRATIONS.fields} | {
        "class_crse_id": "004321", "class_number": "00123", "class_course": "AA 1", "time_strm": 20191,
        "stdnt_emplid": "000777", "credit_hours": 0.5, "class_grade": "A", "time_academic_yr": "2019",
    }
    kinds = ", ".join(
        f"{f.name} {'double' if f.name == 'credit_hours' else f.dataType.simpleString()}" for f in schemas.REGISTRATIONS.fields
    )
    df = spark.createDataFrame([tuple(row.values())], kinds)
    got = passed_registrations(conform(df, schemas.REGISTRATIONS)).collect()
    assert [(r.credit_hours, r.uniq_combo_id) for r in got] == [(Decimal("0.50"), "00123AA 120191000777")]


def test_csv_is_cleaned_before_it_is_cast(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="csv-"), "t.csv")
    with open(path, "wb") as f:
        f.write(b"id,n,s\n,1,a  \n\nx,, NULL\ny,NULL,NULL\nz,3,\xff!\n")
    schema = StructType([StructField("id", StringType()), StructField("n", IntegerType()), StructField("s", StringType())])
    rows = sorted((tuple(r) for r in read_csv(spark, path, schema).collect()), key=str)
    assert rows == [("x", None, " NULL"), ("y", None, None), ("z", 3, "�!"), (None, 1, "a")]


def test_repeated_years_are_reported(spark):
    year, payout = read_year_matrix(spark), read_payout_matrix(spark)
    assert repeated_years(year, payout).count() == 0
    twice = year.unionAll(year.where(F.col("FY") == 2020))
    assert [tuple(r) for r in repeated_years(twice, payout).collect()] == [("year_matrix", 2020, 2)]


def _file(text: bytes, name="t.csv"):
    path = os.path.join(tempfile.mkdtemp(prefix="csv-"), name)
    with open(path, "wb") as f:
        f.write(text)
    return path


ROW = StructType([StructField("id", StringType()), StructField("t", StringType()), StructField("n", IntegerType())])


def test_csv_fields_are_bound_by_name(spark):
    path = _file(b"\xef\xbb\xbft,extra,id,n\nx,?,1,5\n")
    assert [tuple(r) for r in read_csv(spark, path, ROW).collect()] == [("1", "x", 5)]


def test_csv_lacking_a_column_or_with_another_header_raises(spark):
    with pytest.raises(ValueError, match="no column n"):
        read_csv(spark, _file(b"id,t\n1,x\n"), ROW)
    folder = os.path.dirname(_file(b"id,t,n\n1,x,5\n", "a.csv"))
    with open(os.path.join(folder, "b.csv"), "w") as f:
        f.write("t,id,n\nx,1,5\n")
    with pytest.raises(Exception):
        read_csv(spark, folder, ROW).collect()


def test_csv_quotes_and_line_breaks(spark):
    path = _file(b'id,t,n\r\n1,"a ""quoted"" word, and\nmore",5\r\n\r\n2,"back\\",6\r\n3,"",7\r\n4,"NULL",8\r\n')
    got = sorted(tuple(r) for r in read_csv(spark, path, ROW).collect())
    assert got == [("1", 'a "quoted" word, and\nmore', 5), ("2", "back\\", 6), ("3", None, 7), ("4", None, 8)]


def test_csv_round_trip(spark):
    from cohortalloc.sinks import write_csv

    texts = ['say "hi"', "a,b", "line\nbreak", "cr\rlf\r\n.", "\\", '\\"', '"', "'", "é€😀", "  lead", "\ttab", "#x", "a\n\nb", None]
    df = spark.createDataFrame([(str(i), t, i) for i, t in enumerate(texts)], "id string, t string, n int")
    path = os.path.join(tempfile.mkdtemp(prefix="csv-"), "out")
    write_csv(df.select("n", "t", "id"), path)
    got = {r.n: r.t for r in read_csv(spark, path, ROW).collect()}
    assert got == dict(enumerate(texts))


@pytest.mark.parametrize("width", range(8))
def test_widths_are_octets_and_never_split_a_character(spark, width):
    texts = ["aé", "aéb", "日本語", "😀x", "abcdefgh", "a😀", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(cut_to_octets(F.col("t"), width)).collect()]
    assert got == [None if t is None else t.encode()[:width].decode(errors="ignore") for t in texts]


def test_cleaning_report_counts(spark):
    df = spark.createDataFrame(
        [("abc  ", 1), ("NULL", 2), ("  ", 3), (None, 4), ("ééé", 5), (" NULL", 6)], "t string, n int"
    ).withColumn("bad", F.when(F.col("n") == 1, F.expr("CAST(X'61FF' AS STRING)")))
    got = {r["column"]: tuple(r)[1:] for r in cleaning_report(df, {"t": 4}).collect()}
    assert got == {"t": (5, 2, 2, 0), "bad": (1, 0, 0, 1)}


@pytest.mark.parametrize("value,kind", [(9007199254740993, "long"), (Decimal("12345678901234567.01"), "decimal(38,2)")])
def test_conform_refuses_a_number_that_no_double_holds(spark, value, kind):
    schema = StructType([StructField("n", DoubleType())])
    with pytest.raises(Exception, match="cannot keep"):
        conform(spark.createDataFrame([(value,)], f"n {kind}"), schema).collect()
    assert conform(spark.createDataFrame([(2**53,)], "n long"), schema).first().n == 2.0**53
    assert conform(spark.createDataFrame([(Decimal("0.10"),)], "n decimal(9,2)"), schema).first().n == 0.1


def test_lookup_files_are_bound_by_name_and_bounded(spark, monkeypatch):
    from cohortalloc.sources import lookups

    path = _file(b"year,gap,ssi_payout_y3,ssi_payout_y2,ssi_payout_y1,year_basis\n2013,1,2016,2015,2014,fiscal\n")
    assert tuple(read_payout_matrix(spark, path).first()) == (2013, 2014, 2015, 2016, 1, "fiscal")
    monkeypatch.setattr(lookups, "LOOKUP_BYTES", 10)
    with pytest.raises(ValueError, match="bytes"):
        read_payout_matrix(spark, path)
