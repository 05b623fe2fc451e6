"""Steps that must not grow faster than their input: fixed partition counts, fan-outs, repeated evaluation."""

import pytest

from cohortalloc import session
from cohortalloc.operators.audit import model_id_discrepancy_rows
from cohortalloc.operators.registration import REGISTRATION_COLUMNS, distinct_merged_rows, match_outcomes, merged_rows
from cohortalloc.plans import catalog, refresh
from cohortalloc.plans.catalog import QUERIES
from cohortalloc.sinks.buckets import store_match_facts
from cohortalloc.sinks.writers import store
from cohortalloc.sources.fixtures import fixture_sources
from cohortalloc.sources.lookups import read_year_matrix

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_order_lines_are_dealt_to_as_many_partitions_as_the_session_wants(spark):
    assert "REPARTITION_BY_NUM" not in plan(fixture_sources(spark, SF).registrations)
    assert "REPARTITION_BY_COL" in plan(fixture_sources(spark, SF).registrations)


def test_discrepancy_rows_are_made_once_and_not_shuffled(spark):
    merged = [("A 1", 20201, "X"), ("A 1", 20201, "X"), ("A 1", 20201, None), ("B 2", 20201, "Y"), (None, 20201, "Z")]
    merged = spark.createDataFrame(merged, "class_course string, time_strm int, newid string")
    inventory = [("A 1", 20201, "X"), ("A 1", 20201, "W"), ("A 1", 20201, "W"), ("A 1", 20201, None), ("A 1", 20202, "V"), (None, 20201, "Z")]
    inventory = spark.createDataFrame(inventory, "class_course string, strm int, newid string")
    rows = model_id_discrepancy_rows(merged, inventory)
    assert rows.columns == ["class_course", "time_strm", "newid", "ci_newid", "newid_equal"]
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [("A 1", 20201, "X", "X", 1), ("A 1", 20201, "X", "W", 0), ("A 1", 20201, "X", None, 1), ("A 1", 20201, None, "X", 1),
         ("A 1", 20201, None, "W", 1), ("A 1", 20201, None, None, 1), ("B 2", 20201, "Y", None, 1), (None, 20201, "Z", None, 1)], key=str)
    above = plan(rows).split("Join")[0]
    assert "Generate" in above and "Aggregate" not in above and "Exchange" not in above


def test_hot_keys_are_stored_once(spark):
    keys = [(20201, "00001", "P1")] * 5 + [(20201, "00002", "P2")]
    passed = spark.createDataFrame(keys, "time_strm int, new_class_number string, campus_id string")
    eligible = spark.createDataFrame(keys, "strm int, class_nbr string, student_pid string")
    registered, enrolled = store_match_facts(spark, passed, eligible, "test_hot", buckets=2, hot_rows=3, salts=4)
    assert [tuple(r) for r in spark.table("test_hot_hot_keys").collect()] == [(20201, "00001", "P1", 5)]
    assert (registered.count(), enrolled.count()) == (5 * 4 + 1, 6)


@pytest.mark.parametrize("held", [[2018, 2019], [2019]])
def test_a_refresh_computes_the_changed_years_once(spark, tmp_path, held):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    kind = "newid string, class_course string, credit_hours decimal(10,2), time_academic_yr int, calendar_year int"
    rows = [("M", "A 1", None, year, year) for year in held for _ in range(4)]
    matched = spark.createDataFrame(rows, kind).coalesce(1)
    matrix, path = read_year_matrix(spark), str(tmp_path / "hours")
    refresh.store_hours(matched, matrix, path)
    empty = refresh.refresh_hours(matched.where("time_academic_yr = 2019").mapInArrow(counted, matched.schema), matrix, path, [2018, 2019])
    assert seen.value == 4
    assert bool(empty) == (2018 in held)
    assert not (tmp_path / "hours_fresh").exists()


def test_tasks_grow_in_number_with_the_input(spark, tmp_path, monkeypatch):
    start, merged = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(merged)
    (tmp_path / "part").write_bytes(bytes(3000))
    monkeypatch.setattr(session, "INPUT_BYTES_PER_PARTITION", 100)
    try:
        spark.conf.set(merged, "128m")
        session.bounded_tasks(spark, str(tmp_path), str(tmp_path / "part"))
        assert spark.conf.get(start) == "60" and spark.conf.get(merged) == str(session.TASK_BYTES)
        spark.conf.set(merged, "8m")
        session.bounded_tasks(spark, str(tmp_path))
        assert spark.conf.get(start) == "60" and spark.conf.get(merged) == "8m"  # more and smaller tasks stay
        spark.conf.set(merged, "128m")
        _ = fixture_sources(spark, SF).registrations
        assert spark.conf.get(merged) == str(session.TASK_BYTES)
    finally:
        spark.conf.unset(start)
        spark.conf.set(merged, before)


@pytest.mark.parametrize("name", ["course_payouts", "course_completeness_recoded", "course_reconciliation"])
def test_course_rows_and_rates_share_one_stored_match(spark, name):
    read = QUERIES[name](spark, SF).inputFiles()
    assert not [x for x in read if "lineitem.parquet" in x]
    assert [x for x in read if "_matched_" in x] and [x for x in read if "_allocated_rates_" in x]


def shuffle_files(spark) -> int:
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").count("/shuffle_")


def test_a_stored_step_leaves_no_shuffle_files(spark, tmp_path):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count().write.parquet(str(tmp_path / "plain"))
    assert shuffle_files(spark) > 0
    kept = shuffle_files(spark)
    held = store(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), str(tmp_path / "held"))
    assert shuffle_files(spark) <= kept
    assert sorted(r["count"] for r in held.collect()) == [142] + [143] * 6
    assert spark.conf.get(setting) == before


def test_refreshed_rates_read_one_stored_match(spark, monkeypatch):
    read = {}
    for name in ("store_hours", "refresh_hours"):
        def seen(matched, *args, name=name, run=getattr(catalog, name)):
            read[name] = matched.inputFiles()
            return run(matched, *args)

        monkeypatch.setattr(catalog, name, seen)
    QUERIES["refreshed_rates"](spark, SF)
    assert set(read) == {"store_hours", "refresh_hours"}
    for files in read.values():
        assert files and all("refreshed_rates_matched_" in x for x in files)


def test_discrepancy_rows_read_one_stored_join(spark):
    read = QUERIES["model_id_discrepancy_rows"](spark, SF).inputFiles()
    assert not [x for x in read if "lineitem.parquet" in x] and [x for x in read if "_merged_distinct_" in x]


def test_course_subsidy_reads_stored_sides(spark):
    read = QUERIES["course_subsidy"](spark, SF).inputFiles()
    assert not [x for x in read if "lineitem.parquet" in x]
    assert [x for x in read if "_passing_" in x] and [x for x in read if "_eligible_" in x]


def test_distinct_merged_rows_are_the_distinct_of_the_merged_rows(spark):
    keys = [(20201, "00001", "P1", "a"), (20201, "00001", "P1", "b"), (20201, "00002", "P2", "a"), (20202, None, "P3", "a"), (None, None, None, None)]
    passed = spark.createDataFrame(keys, "time_strm int, new_class_number string, campus_id string, class_title_ld string")
    passed = passed.selectExpr("*", *[f"CAST(NULL AS STRING) AS {c}" for c in REGISTRATION_COLUMNS if c not in passed.columns]).select(*REGISTRATION_COLUMNS)
    enrolled = [
        (20201, "00001", "P1", "20201F", 2020, "DOC11", 1), (20201, "00001", "P1", "20201F", 2020, "DOC11", 1),
        (20201, "00001", "P1", "20201F", 2021, "Doc11", 1), (20201, "00001", "P1", "20201F", 2020, None, None),
        (20201, "00001", "P1", "20201F", None, None, None), (20202, None, "P3", "20202F", 2020, "MED11", 1), (None, None, None, None, None, None, None),
    ]
    kind = "strm int, class_nbr string, student_pid string, term_code string, calendar_year int, newid string, completed_flag int"
    eligible = spark.createDataFrame(enrolled, kind).selectExpr("*", "1 AS subsidy_eligible_code", "CAST(NULL AS STRING) AS crse_grade_off")
    merged = merged_rows(match_outcomes(passed, eligible))
    got = distinct_merged_rows(passed, eligible)
    assert got.dtypes == merged.dtypes and merged.count() == 13
    assert sorted(map(str, got.collect())) == sorted(map(str, merged.distinct().collect())) and got.count() == 7
    assert "Aggregate" not in plan(got).split("Join")[0]
