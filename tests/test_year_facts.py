"""Registrations by academic year: only the matrices' years are read, and no result changes."""

import os
import re
import tempfile

from pyspark.sql import functions as F

from cohortalloc.plans.pipelines import Allocation
from cohortalloc.sources import schemas
from cohortalloc.sources.fixtures import FixtureViews
from cohortalloc.sources.year_facts import read_by_year, write_by_year, years_in_use

SF = "/root/testdata/sf0.001"


def with_registrations(spark, registrations):
    views = FixtureViews(spark, SF)
    views.registrations = registrations
    return Allocation(views, "INST")


def test_years_outside_the_matrices_are_not_read(spark):
    views = FixtureViews(spark, SF)
    path = os.path.join(tempfile.mkdtemp(prefix="years-"), "registrations")
    regs = views.registrations
    odd = regs.limit(5).withColumn("time_academic_yr", F.lit("1999")).unionAll(regs.limit(3).withColumn("time_academic_yr", F.lit(None).cast("string")))
    everything = regs.unionAll(odd)
    write_by_year(everything, path)
    years = years_in_use(views.year_matrix, views.payout_matrix)
    assert years == list(range(2010, 2035))
    held = read_by_year(spark, path, schemas.REGISTRATIONS, years)
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*time_academic_yr", plan), plan
    assert "time_academic_yr=1999" in os.listdir(path)
    seen = {r[0] for r in held.select(F.regexp_extract(F.input_file_name(), "time_academic_yr=([^/]*)", 1)).distinct().collect()}
    assert "__HIVE_DEFAULT_PARTITION__" in seen and seen - {"__HIVE_DEFAULT_PARTITION__"} <= {str(y) for y in years}
    # the same pipeline results as from all registrations
    got, want = with_registrations(spark, held), with_registrations(spark, everything)
    for name in ("year_type_hours", "payout_years"):
        frames = [getattr(a, name) for a in (got, want)]
        assert sorted(map(str, frames[0].collect())) == sorted(map(str, frames[1].collect())), name
