"""Stratified assignment and readout of a two-arm retention experiment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from keepwell.functions import tails
from keepwell.functions.scoring import MONTHS, target_population
from keepwell.operators.quantiles import bin_index, quantile_edges
from keepwell.operators.ranking import flag_half

# --- fixed values ------------------------------------------------------------
ALPHA = 0.05
STRATA = 10
OFFER_COST = 50.0
# --- end of fixed values ----------------------------------------------------


def assign_arms(scored: DataFrame, threshold: float, seed, key: str = "customerID",
                strata: int = STRATA, score: str = "churn_probability") -> DataFrame:
    """Half of every risk stratum (rounded down) is treated, in seeded order; customers are flagged where they lie."""
    # Read five times below (edges, slot counts, rows); kept once, spilling to disk.
    targeted = target_population(scored.filter(F.col(score) >= threshold).persist(), threshold, score)
    edges = quantile_edges(targeted, score, strata)
    stratified = targeted.withColumn("risk_stratum", bin_index(F.col(score), edges))
    flagged = flag_half(stratified, key, seed, "_first", ["risk_stratum"])
    return flagged.withColumn("group", F.when(F.col("_first"), "treatment").otherwise("control")).drop("_first")


def with_outcomes(assigned: DataFrame, churned: Column, offer_cost: float = OFFER_COST) -> DataFrame:
    """Observed churn, retention and net annual revenue per customer."""
    cost = F.when(F.col("group") == "treatment", F.lit(offer_cost)).otherwise(F.lit(0.0))
    out = assigned.withColumn("churned", churned.cast("int"))
    out = out.withColumn("retained", 1 - F.col("churned"))
    return out.withColumns({
        "revenue": F.col("retained") * F.col("MonthlyCharges") * MONTHS,
        "revenue_net": F.col("retained") * F.col("MonthlyCharges") * MONTHS - cost})


def arms_wide(outcomes: DataFrame, metrics, treatment: str = "treatment",
              by=()) -> DataFrame:
    """Per metric one row with n, sum, mean and variance of both arms.

    Everything later is arithmetic on this; the raw rows are read once.
    """
    arm = F.col("group") == treatment
    stats = []
    for m in metrics:
        x = F.col(m).cast("double")
        stats.append(F.struct(
            F.lit(m).alias("metric"),
            F.count(F.when(arm, x)).alias("n_t"), F.count(F.when(~arm, x)).alias("n_c"),
            F.sum(F.when(arm, x)).alias("sum_t"), F.sum(F.when(~arm, x)).alias("sum_c"),
            F.avg(F.when(arm, x)).alias("mean_t"), F.avg(F.when(~arm, x)).alias("mean_c"),
            F.var_samp(F.when(arm, x)).alias("var_t"), F.var_samp(F.when(~arm, x)).alias("var_c")))
    one = outcomes.groupBy(*by).agg(*[s.alias(f"m{i}") for i, s in enumerate(stats)])
    cells = F.array(*[F.col(f"m{i}") for i in range(len(stats))])
    return one.select(*by, F.explode(cells).alias("m")).select(*by, "m.*")


def two_proportion_z(arms: DataFrame, p_values: bool = True) -> DataFrame:
    """Pooled z with p, unpooled 95% interval, lift and Cohen's h.

    Expects ``sum_t, n_t, sum_c, n_c``; columns of the input are kept.
    """
    crit = tails.normal_quantile(1 - ALPHA / 2)
    pt, pc = F.col("rate_treatment"), F.col("rate_control")
    nt, nc = F.col("n_t"), F.col("n_c")
    pool = (F.col("sum_t") + F.col("sum_c")) / (nt + nc)
    out = arms.withColumns({"rate_treatment": F.col("sum_t") / nt, "rate_control": F.col("sum_c") / nc})
    out = out.withColumns({
        "absolute_difference": pt - pc,
        "relative_lift": F.try_divide(pt - pc, pc),
        "se_pooled": F.sqrt(pool * (1 - pool) * (1 / nt + 1 / nc)),
        "se_unpooled": F.sqrt(pt * (1 - pt) / nt + pc * (1 - pc) / nc),
        "cohens_h": 2 * F.asin(F.sqrt(pt)) - 2 * F.asin(F.sqrt(pc)),
    })
    diff, se = F.col("absolute_difference"), F.col("se_unpooled")
    out = out.withColumns({
        "z_statistic": F.when(F.col("se_pooled") == 0, F.lit(0.0)).otherwise(F.try_divide(diff, F.col("se_pooled"))),
        "ci_low": diff - crit * se, "ci_high": diff + crit * se})
    if p_values:
        out = out.withColumn("p_value", tails.p_normal(F.col("z_statistic")))
        out = out.withColumn("significant", F.col("p_value") < ALPHA)
    return out


def contingency(outcomes: DataFrame, row: str = "group", outcome: str = "churned") -> DataFrame:
    return outcomes.groupBy(row).pivot(outcome, [0, 1]).count().na.fill(0, ["0", "1"])


def chi_square_2x2(table: DataFrame, row: str = "group", p_values: bool = True) -> DataFrame:
    """Yates-corrected independence test on a 2x2 table (two rows of counts)."""
    first = F.min(row)
    cells = table.select(row, F.col("0").alias("a"), F.col("1").alias("b"))
    one = cells.agg(
        F.min_by("a", row).alias("n00"), F.min_by("b", row).alias("n01"),
        F.max_by("a", row).alias("n10"), F.max_by("b", row).alias("n11"))
    names = ["n00", "n01", "n10", "n11"]
    n = reduce(lambda x, y: x + y, [F.col(c) for c in names])
    out = one.withColumn("n", n)
    chi = F.lit(0.0)
    for r in (0, 1):
        for c in (0, 1):
            expected = ((F.col(f"n{r}0") + F.col(f"n{r}1")).cast("double")
                        * (F.col(f"n0{c}") + F.col(f"n1{c}")) / F.col("n"))
            gap = F.abs(F.col(f"n{r}{c}") - expected)
            corrected = gap - F.least(F.lit(0.5), gap)
            chi = chi + F.coalesce(F.try_divide(corrected * corrected, expected), F.lit(0.0))
    out = out.withColumn("chi2_statistic", chi).withColumn("degrees_of_freedom", F.lit(1))
    out = out.withColumn("cramers_v", F.sqrt(F.col("chi2_statistic") / F.col("n")))
    if p_values:
        out = out.withColumn("p_value", tails.p_chi2_one(F.col("chi2_statistic")))
        out = out.withColumn("significant", F.col("p_value") < ALPHA)
    return out


def welch_t(arms: DataFrame, p_values: bool = True) -> DataFrame:
    """Welch's t, Satterthwaite degrees of freedom, pooled-SD Cohen's d."""
    nt, nc, vt, vc = (F.col(c) for c in ("n_t", "n_c", "var_t", "var_c"))
    at, ac = vt / nt, vc / nc
    out = arms.withColumns({
        "difference": F.col("mean_t") - F.col("mean_c"),
        "se_difference": F.sqrt(at + ac),
        "degrees_of_freedom": F.try_divide((at + ac) * (at + ac),
                                           at * at / (nt - 1) + ac * ac / (nc - 1)),
        "pooled_sd": F.sqrt(((nt - 1) * vt + (nc - 1) * vc) / (nt + nc - 2))})
    out = out.withColumns({
        "t_statistic": F.try_divide("difference", "se_difference"),
        "cohens_d": F.coalesce(F.try_divide("difference", "pooled_sd"), F.lit(0.0))})
    if p_values:
        out = out.withColumns({
            "p_value": tails.p_student(F.col("t_statistic"), F.col("degrees_of_freedom")),
            "_crit": tails.q_student(1 - ALPHA / 2, F.col("degrees_of_freedom"))})
        out = out.withColumns({
            "ci_low": F.col("difference") - F.col("_crit") * F.col("se_difference"),
            "ci_high": F.col("difference") + F.col("_crit") * F.col("se_difference"),
            "significant": F.col("p_value") < ALPHA}).drop("_crit")
    return out


def business_impact(arms: DataFrame, offer_cost: float = OFFER_COST) -> DataFrame:
    """Net gain over the treated arm and campaign cost, from the revenue row."""
    return arms.filter(F.col("metric") == "revenue_net").select(
        F.col("n_t").alias("n_treatment"),
        ((F.col("mean_t") - F.col("mean_c")) * F.col("n_t")).alias("net_revenue_gain"),
        (F.lit(offer_cost) * F.col("n_t")).alias("campaign_cost"))


def holm(p_values: DataFrame, name: str = "metric", p: str = "p_value", by=(),
         alpha: float = ALPHA) -> DataFrame:
    """Step-down correction over a family of tests (one row per test)."""
    family = Window.partitionBy(*by)
    ordered = family.orderBy(p, name)
    m = F.count("*").over(family)
    i = F.row_number().over(ordered) - 1
    out = p_values.withColumn("adjusted_threshold", F.lit(alpha) / (m - i))
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return out.withColumn("significant_after_correction",
                          F.bool_and(F.col(p) < F.col("adjusted_threshold")).over(running))


def same_arm_halves(outcomes: DataFrame, seed, key: str = "customerID") -> DataFrame:
    """A/A control: the control arm cut in two by seeded order."""
    control = outcomes.filter(F.col("group") == "control").persist()
    flagged = flag_half(control, key, seed, "_first")
    return flagged.withColumn("group", F.when(F.col("_first"), "treatment").otherwise("control")).drop("_first")
