"""Degree completions: dollars per degree over three payout years.

degree_basis            completions on active plans, paired with the model's
                        dollars of FY = academic year + 1 (doctoral variant:
                        PhD completions and the FY's doctoral degree pool)
attach_degree_counts    cohort degree counts of y1, y2, y3
attach_degree_dollars   dollars of y2, y3 taken from the y1 amounts in the data
model_years             counts and amounts of a model by year, one row per model
attach_model_years      dollars and counts of all three years in one look-up
average_per_degree      rounded dollars per degree and their three-year sum
finish_degrees          completeness flag, NULL downgrade, amount rounding
degree_stats            min / max / mean / median of complete rows
degree_flag_check       distinct year / flag combinations
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortalloc.functions.expressions import exact_sum, round_half_even, round_half_up, safe_ratio
from cohortalloc.operators.cohorts import cohort_slots
from cohortalloc.operators.payouts import PAYOUT_YEARS, attach_status, downgrade_missing

COMBO_COLUMNS = [
    "stdnt_emplid", "matchid", "completion_term", "plan_acad_plan_ld", "plan_acad_plan_code",
    "degree_ocurred",
]
COUNT_COLUMNS = ("ssi_payout_y1_total_degree", "ssi_payout_y2_total_degree", "ssi_payout_y3_total_degree")
AMOUNT_COLUMNS = ("ssi_y1_payout_total_amount", "ssi_y2_payout_total_amount", "ssi_y3_payout_total_amount")
AVERAGE_COLUMNS = (
    "ssi_payout_avg_y1_per_degree", "ssi_payout_avg_y2_per_degree", "ssi_payout_avg_y3_per_degree",
)
TOTAL_COLUMN = "total_all_three_years_ssi_per_degree"
DEGREE_OUTPUT = [
    *COMBO_COLUMNS, *PAYOUT_YEARS, *COUNT_COLUMNS, *AMOUNT_COLUMNS, *AVERAGE_COLUMNS,
    TOTAL_COLUMN, "complete_flag",
]


def completions_on_active_plans(
    completions: DataFrame, acad_plans: DataFrame, phd_only: bool = False
) -> DataFrame:
    """Distinct completions matched to an active plan of their term."""
    plans = acad_plans.where(F.col("eff_status") == "A").select(
        F.col("strm").alias("p_strm"), F.col("acad_plan").alias("p_plan"), "matchid"
    )
    comp = completions.where(F.col("degree_cd") == "PHD") if phd_only else completions
    joined = comp.join(
        plans,
        (plans.p_strm == comp.completion_term) & (plans.p_plan == comp.plan_acad_plan_code),
        "inner",
    )
    return joined.select(
        "stdnt_emplid",
        "matchid",
        "completion_term",
        F.col("time_academic_year").alias("degree_ocurred"),
        "plan_acad_plan_ld",
        "plan_acad_plan_code",
    ).distinct()


def _with_payout(combo: DataFrame, dollars: DataFrame, by_model: bool) -> DataFrame:
    cond = combo.degree_ocurred == dollars.d_fy - 1
    if by_model:
        cond = cond & (dollars.d_match == combo.matchid)
    joined = combo.join(dollars, cond, "inner")
    fy = F.col("d_fy").cast("int")
    return joined.select(
        *COMBO_COLUMNS,
        fy.alias("ssi_payout_y1"),
        (fy + 1).alias("ssi_payout_y2"),
        (fy + 2).alias("ssi_payout_y3"),
        round_half_up(F.col("d_total"), 1).alias("ssi_y1_payout_total_amount"),
    )


def degree_basis(
    completions: DataFrame, acad_plans: DataFrame, degree_allocations: DataFrame, institution: str
) -> DataFrame:
    combo = completions_on_active_plans(completions, acad_plans)
    return _with_payout(combo, model_dollars(degree_allocations, institution), by_model=True)


def doctoral_degree_basis(
    completions: DataFrame, acad_plans: DataFrame, doctoral_subsidy: DataFrame, institution: str
) -> DataFrame:
    combo = completions_on_active_plans(completions, acad_plans, phd_only=True)
    return _with_payout(combo, pool_dollars(doctoral_subsidy, institution), by_model=False)


def attach_degree_counts(basis: DataFrame, cohort_totals: DataFrame, by_model: bool = True) -> DataFrame:
    """Cohort degree counts for the three payout FYs (NULL when none)."""
    targets = dict(zip(COUNT_COLUMNS, PAYOUT_YEARS))
    # by model: keyed by (model, FY), so that a model's degrees spread over the years
    out = basis
    for col, year in targets.items():
        keys = [F.col("matchid").alias("_model")] if by_model else []
        t = cohort_totals.select(*keys, F.col("fiscal_year").alias("_fy"), F.col("total_degrees").alias(col))
        cond = out[year] == t._fy
        if by_model:
            cond = cond & out.matchid.eqNullSafe(t._model)
        out = out.join(t, cond, "left").drop("_fy", "_model")
    return out


def attach_degree_dollars(rows: DataFrame, by_model: bool = True) -> DataFrame:
    """Dollars of y2 and y3, looked up among the (model,) y1 amounts of the data.

    A fiscal year with no completions for the model has no amount (NULL).
    The amounts table is the distinct (model, FY, amount) set; it is joined
    with plain left joins so that a FY carrying two amounts fans out exactly
    as the published rule does.
    """
    keys = ["matchid"] if by_model else []
    amounts = rows.select(*keys, "ssi_payout_y1", "ssi_y1_payout_total_amount").distinct()
    out = rows
    for col, year in (("ssi_y2_payout_total_amount", "ssi_payout_y2"), ("ssi_y3_payout_total_amount", "ssi_payout_y3")):
        t = amounts.select(
            *[F.col(k).alias(f"_a_{k}") for k in keys],
            F.col("ssi_payout_y1").alias("_a_fy"),
            F.col("ssi_y1_payout_total_amount").alias(col),
        )
        cond = out[year] == t._a_fy
        for k in keys:
            cond = cond & out[k].eqNullSafe(t[f"_a_{k}"])
        out = out.join(t, cond, "left").drop("_a_fy", *[f"_a_{k}" for k in keys])
    return out


#: Copies of a model's look-up row; the degrees of one model are spread over as many tasks.
SALTS = 32


def model_dollars(degree_allocations: DataFrame, institution: str) -> DataFrame:
    """One institution's degree dollars per (model, fiscal year)."""
    return degree_allocations.where(F.col("inst") == institution).select(
        F.col("match_id").alias("d_match"),
        F.col("fiscal_year").alias("d_fy"),
        F.col("total_ssi").alias("d_total"),
    )


def pool_dollars(doctoral_subsidy: DataFrame, institution: str) -> DataFrame:
    """One institution's doctoral degree pool per fiscal year."""
    return doctoral_subsidy.where(F.col("inst") == institution).select(
        F.col("fiscal_year").alias("d_fy"), F.col("degrees").alias("d_total")
    )


def model_years(combo: DataFrame, dollars: DataFrame, year_matrix: DataFrame, by_model: bool = True) -> DataFrame:
    """One row per model (``by_model=False``: one for all): ``by_year``, a map by fiscal year.

    ``paid`` holds the year's amounts as first-year dollars, one per funding
    row; ``amounts`` the distinct ones that some degree was paid in the data
    (what second and third years look up); ``degrees`` the cohort's number of
    degrees (NULL if none).  The degrees are counted per (model, year) before
    anything is joined, so what is joined and folded here has one row per
    model and year, however many degrees there are.
    """
    keys = ["matchid"] if by_model else []
    per_year = combo.groupBy(*keys, "degree_ocurred").agg(F.count(F.lit(1)).alias("n"))
    amount = round_half_up(F.col("d_total"), 1)
    # wrapped: a NULL amount is an amount, too
    paid = dollars.groupBy(*(["d_match"] if by_model else []), F.col("d_fy").cast("int").alias("fy")).agg(
        F.collect_list(F.struct(amount.alias("v"))).alias("paid")
    )
    cond = F.col("degree_ocurred") == F.col("fy") - 1
    if by_model:
        cond = cond & (F.col("matchid") == F.col("d_match"))
    rows = per_year.join(paid, cond).select(
        *keys, "degree_ocurred", "fy", "paid", (F.col("n") * F.size("paid")).alias("n")
    )
    slots = cohort_slots(year_matrix).select(F.col("FY").alias("slot"), "AY")
    fed = rows.join(slots, rows.degree_ocurred.eqNullSafe(slots.AY)).select(*keys, F.col("slot").alias("fy"), "n")
    counts = fed.groupBy(*keys, "fy").agg(F.sum("n").alias("degrees"))
    both = rows.select(*keys, "fy", "paid", F.array_distinct("paid").alias("amounts")).join(counts, [*keys, "fy"], "full")
    return both.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("fy", F.struct("paid", "amounts", "degrees")))).alias("by_year")
    )


def attach_model_years(combo: DataFrame, years: DataFrame, by_model: bool = True, salts: int = SALTS) -> DataFrame:
    """Dollars of the first year, cohort counts and later dollars, from one join.

    A model's degrees are spread over ``salts`` tasks and its look-up row is
    there once per salt, so a model that holds a third of all degrees is no
    single task; the degrees are shuffled once at most (not at all if Spark
    finds the look-up small).  A year with several amounts fans a degree out,
    as one join per year would.
    """
    salt = F.pmod(F.xxhash64(*COMBO_COLUMNS), F.lit(salts)).cast("int")
    spread = years.select(
        *([F.col("matchid").alias("_model")] if by_model else []),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_years_salt"),
        "by_year",
    )
    cond = F.col("_salt") == F.col("_years_salt")
    if by_model:
        cond = cond & (F.col("matchid") == F.col("_model"))
    rows = combo.withColumn("_salt", salt).join(spread, cond)
    first = (F.col("degree_ocurred") + 1).cast("int")
    rows = rows.withColumns({year: first + i for i, year in enumerate(PAYOUT_YEARS)})
    held = [F.try_element_at(F.col("by_year"), F.col(year)) for year in PAYOUT_YEARS]
    rows = rows.withColumns({col: at["degrees"] for col, at in zip(COUNT_COLUMNS, held)})
    # inner: a year without funding pays no degree; outer: a later year may have none
    rows = rows.withColumn("_hit", F.explode(held[0]["paid"])).withColumn(AMOUNT_COLUMNS[0], F.col("_hit.v"))
    for col, at in zip(AMOUNT_COLUMNS[1:], held[1:]):
        rows = rows.withColumn("_hit", F.explode_outer(at["amounts"])).withColumn(col, F.col("_hit.v"))
    return rows.select(*COMBO_COLUMNS, *PAYOUT_YEARS, *COUNT_COLUMNS, *AMOUNT_COLUMNS)


def average_per_degree(rows: DataFrame) -> DataFrame:
    """amount / degrees per payout year, rounded to 0.1 (ties to even), and
    the sum of the three rounded values (NULL if any is NULL)."""
    avgs = {
        avg: round_half_even(safe_ratio(F.col(amt), F.col(cnt)), 1)
        for avg, amt, cnt in zip(AVERAGE_COLUMNS, AMOUNT_COLUMNS, COUNT_COLUMNS)
    }
    out = rows.withColumns(avgs)
    return out.withColumn(
        TOTAL_COLUMN, F.col(AVERAGE_COLUMNS[0]) + F.col(AVERAGE_COLUMNS[1]) + F.col(AVERAGE_COLUMNS[2])
    )


def finish_degrees(rows: DataFrame, year_matrix: DataFrame) -> DataFrame:
    """Completeness flag, downgrade where the total is missing, rounding of the
    three amounts, final column order."""
    flagged = downgrade_missing(attach_status(rows, year_matrix), TOTAL_COLUMN)
    rounded = flagged.withColumns({c: round_half_even(F.col(c), 1) for c in AMOUNT_COLUMNS})
    return rounded.select(*DEGREE_OUTPUT)


def degree_stats(final: DataFrame, by: list[str], scale: int = 2) -> DataFrame:
    """min / max / mean / median of the three-year total over complete rows.

    The totals are sums of values rounded to 0.1, so the mean is taken from
    an exact DECIMAL sum (``scale`` digits) and is independent of row order.
    The exact median keeps a value -> count map per group (merged from
    partial aggregates); a degree's total depends only on its model and
    payout years, so a group holds at most one distinct value per fiscal
    year, however many degrees it counts.
    """
    total = F.col(TOTAL_COLUMN)
    return (
        final.where(F.col("complete_flag") == "complete")
        .groupBy(*by)
        .agg(
            F.min(total).alias("min"),
            F.max(total).alias("max"),
            (exact_sum(total, scale).cast("double") / F.count(total)).alias("mean"),
            F.median(total).alias("median"),
        )
    )


def degree_flag_check(final: DataFrame) -> DataFrame:
    """Distinct (year, payout years, flag); callers sort for display only."""
    return final.select("degree_ocurred", *PAYOUT_YEARS, "complete_flag").distinct()
