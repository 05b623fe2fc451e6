"""Domain views derived from the star-schema test tables.

The test data are order lines, orders, customers and parts.  Each view below
re-reads them as one of the warehouse tables the pipelines expect (course
registrations, enrollments, term lookup, funding totals, completions, plans,
course inventory), so every pipeline runs on data that grows with the
scale factor.  The same definitions exist as SQL in
``cohortalloc.plans.oracle`` for the DuckDB cross-check.

Dollar sums are taken in DECIMAL so that the fixture amounts are exact and do
not depend on the order in which partitions are added.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from cohortalloc.functions.expressions import clean_model_id, strict_concat
from cohortalloc.operators.registration import (
    eligible_enrollments,
    match_outcomes,
    passed_registrations,
    unmatched_rows,
)
from cohortalloc.session import bounded_tasks
from cohortalloc.sources.lookups import read_payout_matrix, read_year_matrix
from cohortalloc.sources import schemas
from cohortalloc.sources.readers import conform

INSTITUTIONS = ("INST", "OTHR")
FIXTURE_FY_RANGE = (2014, 2026)
N_PLANS = 60
SECOND_TOTAL_FY = 2017
N_MATCH_IDS = 15

# --- Fixed values of the fixture mapping ------------------------------------
# part type -> subject code
SUBJECT_BY_PART_TYPE = {
    "ECONOMY": "AH",
    "LARGE": "BES",
    "MEDIUM": "MED",
    "PROMO": "DOC",
    "SMALL": "STEM",
}
SUBJECT_OTHER = "UGR"
# grade by cast(l_quantity as int) % 12, in order 0..11 (None = no grade)
GRADE_BY_QUANTITY = ["A", "B+", "C", "D-", "PR", "F", "W", None, "S", "CR", "PR", "A-"]
# market segment -> academic career (others: GRAD)
CAREER_BY_SEGMENT = {"BUILDING": "UGRD", "FURNITURE": "UGRD", "MACHINERY": None}
CAREER_OTHER = "GRAD"
# -----------------------------------------------------------------------------


def _schema(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Column types of the test tables the views read (only the columns used).
# Reading with a declared schema skips the footer-inference job per read.
TEST_TABLE_SCHEMAS = {
    "lineitem": _schema(
        ("l_orderkey", LongType()), ("l_partkey", LongType()), ("l_suppkey", LongType()),
        ("l_linenumber", IntegerType()), ("l_quantity", DoubleType()),
        ("l_extendedprice", DoubleType()), ("l_discount", DoubleType()), ("l_tax", DoubleType()),
        ("l_returnflag", StringType()), ("l_linestatus", StringType()),
    ),
    "orders": _schema(
        ("o_orderkey", LongType()), ("o_custkey", LongType()), ("o_orderstatus", StringType()),
        ("o_orderdate", TimestampNTZType()), ("o_orderpriority", StringType()),
    ),
    "customer": _schema(("c_custkey", LongType()), ("c_mktsegment", StringType())),
    "part": _schema(
        ("p_partkey", LongType()), ("p_name", StringType()), ("p_brand", StringType()),
        ("p_type", StringType()), ("p_size", IntegerType()), ("p_retailprice", DoubleType()),
    ),
}


def _calendar_year(orderdate: Column) -> Column:
    return (F.year(orderdate) + 20).cast("int")


def _term(orderdate: Column) -> Column:
    return (_calendar_year(orderdate) * 10 + F.quarter(orderdate)).cast("int")


def _sql_value(v) -> str:
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)


def _case_sql(expr: str, mapping: dict, default) -> str:
    whens = " ".join(f"WHEN {_sql_value(k)} THEN {_sql_value(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {_sql_value(default)} END"


# The mappings are written as SQL expression text: one parse per expression
# instead of one driver round trip per branch.
def subject(p_type: str) -> Column:
    return F.expr(_case_sql(p_type, SUBJECT_BY_PART_TYPE, SUBJECT_OTHER))


def level(p_size: str) -> Column:
    return F.expr(f"CAST({p_size} % 3 AS STRING)")


def model(partkey: str) -> Column:
    return F.expr(f"CASE WHEN {partkey} % 50 = 0 THEN CAST(NULL AS STRING) ELSE CAST({partkey} % 5 AS STRING) END")


def grade(quantity: str) -> Column:
    return F.expr(_case_sql(f"CAST({quantity} AS INT) % 12", dict(enumerate(GRADE_BY_QUANTITY)), None))


def career(segment: str) -> Column:
    return F.expr(_case_sql(segment, CAREER_BY_SEGMENT, CAREER_OTHER))


class FixtureViews:
    """Lazy fixture views over ``<sf_dir>/<table>.parquet``.

    Every view is a plan over the scanned parquet files; Catalyst prunes the
    columns each query needs and pushes filters into the scans.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def _table(self, name: str, *cols: str) -> DataFrame:
        reader = self.spark.read.schema(TEST_TABLE_SCHEMAS[name])
        return reader.parquet(f"{self.sf_dir}/{name}.parquet").select(*cols)

    @cached_property
    def order_terms(self) -> DataFrame:
        """Distinct (term, calendar year) in which orders were placed; a few
        rows per year, read from the orders table alone."""
        date = F.col("o_orderdate")
        return (
            self._table("orders", "o_orderdate")
            .select(_term(date).alias("strm"), _calendar_year(date).alias("cal"))
            .distinct()
        )

    @cached_property
    def base(self) -> DataFrame:
        # every join and aggregate of the lines runs in tasks of bounded size
        bounded_tasks(self.spark, f"{self.sf_dir}/lineitem.parquet", f"{self.sf_dir}/orders.parquet")
        li = self._table(
            "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        )
        orders = self._table(
            "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
        )
        cust = self._table("customer", "c_custkey", "c_mktsegment")
        part = self._table("part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
        # The orders meet their customers before the lines: the lines are dealt by order and by part
        # only.  The test tables may be one row group each, so the lines are dealt out even if the
        # orders are broadcast; how many partitions that makes is left to the session.
        placed = orders.join(cust, orders.o_custkey == cust.c_custkey)
        joined = (
            li.repartition("l_orderkey")
            .join(placed, li.l_orderkey == placed.o_orderkey)
            .join(part, F.col("l_partkey") == part.p_partkey)
        )
        cal = _calendar_year(F.col("o_orderdate"))
        qtr = F.quarter("o_orderdate")
        return joined.withColumns(
            {
                "cal": cal,
                "ay": (cal + F.when(qtr >= 3, 1).otherwise(0)).cast("int"),
                "strm": _term(F.col("o_orderdate")),
                "pid": F.concat(F.lit("P"), F.lpad(F.col("o_custkey").cast("string"), 8, "0")),
            }
        )

    @cached_property
    def registrations(self) -> DataFrame:
        rows = self.base.select(
            F.expr("lpad(CAST(l_partkey AS STRING), 7, '0')").alias("class_crse_id"),
            F.expr("lpad(CAST(l_partkey % 1000 AS STRING), 3, '0')").alias("class_number"),
            F.col("strm").alias("time_strm"),
            F.expr("concat(p_brand, ' ', CAST(p_size AS STRING))").alias("class_course"),
            F.col("p_name").alias("class_title_ld"),
            F.expr("lpad(CAST(o_custkey AS STRING), 8, '0')").alias("stdnt_emplid"),
            F.col("pid").alias("campus_id"),
            # half hours for every fourth part
            F.expr("CAST(l_linenumber - 1 + CASE WHEN l_partkey % 4 = 0 THEN 0.5 ELSE 0 END AS DOUBLE)").alias("credit_hours"),
            grade("l_quantity").alias("class_grade"),
            career("c_mktsegment").alias("stdnt_acad_career_cd"),
            F.expr("CAST(ay AS STRING)").alias("time_academic_yr"),
        )
        return conform(rows, schemas.REGISTRATIONS)

    @cached_property
    def enrollments(self) -> DataFrame:
        return self.base.select(
            F.expr("lpad(CAST(l_partkey % 1000 AS STRING), 5, '0')").alias("class_nbr"),
            F.col("pid").alias("student_pid"),
            F.expr(
                "concat(CAST(strm AS STRING), "
                "CASE WHEN l_returnflag <> 'N' OR l_discount > CAST(0.05 AS DOUBLE) THEN 'F' ELSE '' END)"
            ).alias("term_code"),
            subject("p_type").alias("enrl_newtax_subject"),
            level("p_size").alias("enrl_course_level"),
            model("l_partkey").alias("enrl_newtax_model"),
            F.expr(
                "CAST(CASE WHEN l_linestatus = 'O' OR l_tax >= CAST(0.04 AS DOUBLE) THEN 1 ELSE 2 END AS INT)"
            ).alias("subsidy_eligible_code"),
            F.expr("CAST(CASE l_suppkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 END AS INT)").alias(
                "completed_flag"
            ),
            F.expr("CAST(NULL AS STRING)").alias("crse_grade_off"),
        )

    @cached_property
    def term_lookup(self) -> DataFrame:
        return self.order_terms.select(
            F.col("strm").cast("string").alias("term_code"),
            F.col("strm"),
            F.col("cal").cast("string").alias("term_year"),
        )

    def _terms_array(self) -> Column:
        # All terms in the data, as one scalar sub-query (a few per year).
        return self.order_terms.select(F.array_sort(F.collect_list("strm"))).scalar()

    def _part_newids(self) -> DataFrame:
        part = self._table("part", "p_partkey", "p_type", "p_size", "p_retailprice")
        raw = strict_concat(subject("p_type"), level("p_size"), model("p_partkey"))
        return part.select(clean_model_id(raw).alias("newid"), "p_retailprice").where(
            F.col("newid").isNotNull()
        )

    @cached_property
    def course_allocations(self) -> DataFrame:
        per_model = self._part_newids().groupBy("newid").agg(
            F.round(F.sum(F.col("p_retailprice").cast("decimal(18,2)")), 2).alias("a")
        )
        fy = F.col("fiscal_year_ssi_recognized")
        amount = (
            F.when(F.col("newid").contains("Doc"), F.lit(0.0))
            .when((fy % 7 == 0) & F.col("newid").endswith("4"), F.lit(None).cast("double"))
            .otherwise(F.round(F.col("a") * (fy - 2010), 2).cast("double"))
        )
        lo, hi = FIXTURE_FY_RANGE
        return (
            per_model.withColumn("inst_code", F.explode(F.array(*map(F.lit, INSTITUTIONS))))
            .withColumn("fiscal_year_ssi_recognized", F.explode(F.sequence(F.lit(lo), F.lit(hi))))
            .select(
                "inst_code",
                "newid",
                F.col("fiscal_year_ssi_recognized").cast("int").alias("fiscal_year_ssi_recognized"),
                amount.alias("ssi_total_amount"),
            )
        )

    @cached_property
    def doctoral_subsidy(self) -> DataFrame:
        per_year = self.base.groupBy("ay").agg(
            F.round(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")), 1)
            .cast("double")
            .alias("completed_fte"),
            F.round(F.sum(F.col("l_quantity").cast("decimal(18,2)")) * 1000, 1)
            .cast("double")
            .alias("degrees"),
        )
        totals = per_year.select(
            F.explode(F.array(*map(F.lit, INSTITUTIONS))).alias("inst"),
            (F.col("ay") + 1).cast("int").alias("fiscal_year"),
            "completed_fte",
            "degrees",
        )
        # one fiscal year carries a second course total (the degree total is the same)
        again = totals.where(F.col("fiscal_year") == SECOND_TOTAL_FY)
        return totals.unionByName(again.withColumn("completed_fte", F.col("completed_fte") + 1000))

    @cached_property
    def completions(self) -> DataFrame:
        b = self.base.where(F.col("o_orderstatus") == "F")
        rows = b.select(
            F.expr("lpad(CAST(o_custkey AS STRING), 8, '0')").alias("stdnt_emplid"),
            F.col("strm").alias("completion_term"),
            F.col("ay").alias("time_academic_year"),
            F.col("c_mktsegment").alias("plan_acad_plan_ld"),
            F.concat(F.lit("PL"), (F.col("o_custkey") % N_PLANS).cast("string")).alias(
                "plan_acad_plan_code"
            ),
            F.when(F.col("o_orderpriority") == "1-URGENT", "PHD").otherwise("BA").alias("degree_cd"),
        )
        return conform(rows, schemas.COMPLETIONS)

    @cached_property
    def acad_plans(self) -> DataFrame:
        terms = self.order_terms.select("strm")
        k = F.col("k")
        return terms.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(N_PLANS - 1)))).select(
            "strm",
            F.concat(F.lit("PL"), k.cast("string")).alias("acad_plan"),
            F.concat(F.lit("M"), (k % N_MATCH_IDS).cast("string")).alias("matchid"),
            F.when(k % 7 == 0, "I").otherwise("A").alias("eff_status"),
        )

    @cached_property
    def degree_allocations(self) -> DataFrame:
        lo, hi = FIXTURE_FY_RANGE
        # generated from the institution list; one row per (inst, model, FY)
        insts = self.spark.range(1).select(F.explode(F.array(*map(F.lit, INSTITUTIONS))).alias("inst"))
        grid = insts.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(N_MATCH_IDS - 1)))).withColumn(
            "fiscal_year", F.explode(F.sequence(F.lit(lo), F.lit(hi)))
        )
        grid = grid.where(~((F.col("k") == 3) & (F.col("fiscal_year") % 2 == 0)))
        total = F.round(
            (F.col("k") + 1) * F.lit(1234.567).cast("decimal(7,3)") * (F.col("fiscal_year") - 2010), 3
        )
        return grid.select(
            "inst",
            F.concat(F.lit("M"), F.col("k").cast("string")).alias("match_id"),
            F.col("fiscal_year").cast("int").alias("fiscal_year"),
            total.cast("double").alias("total_ssi"),
        )

    @cached_property
    def course_inventory(self) -> DataFrame:
        part = self._table("part", "p_partkey", "p_brand", "p_type", "p_size")
        return part.withColumn("strm", F.explode(self._terms_array())).select(
            F.col("strm").cast("int").alias("strm"),
            (F.col("p_partkey") % 3 + 1).alias("strm_version"),
            F.col("p_brand").alias("crse_subject"),
            F.col("p_size").cast("string").alias("crse_catalog_nbr"),
            subject("p_type").alias("hei_subsidy_model_subj"),
            level("p_size").alias("hei_course_level"),
            model("p_partkey").alias("hei_subsidy_model_code"),
            F.when(F.col("p_partkey") % 5 == 0, "N").otherwise("Y").alias("hei_subsidy_eligible"),
        )

    @cached_property
    def unmatched(self) -> DataFrame:
        passed = passed_registrations(self.registrations)
        eligible = eligible_enrollments(self.enrollments, self.term_lookup)
        return unmatched_rows(match_outcomes(passed, eligible))

    @cached_property
    def year_matrix(self) -> DataFrame:
        return read_year_matrix(self.spark)

    @cached_property
    def payout_matrix(self) -> DataFrame:
        return read_payout_matrix(self.spark)


def fixture_sources(spark: SparkSession, sf_dir: str) -> FixtureViews:
    """The fixture views as a lazy source bundle: a view's plan is built only
    when a pipeline stage asks for it (same attribute names as ``Sources``)."""
    return FixtureViews(spark, sf_dir)
