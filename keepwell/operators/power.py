"""Sample size, power and detectable effect as expressions over design rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from keepwell.functions import tails
from keepwell.functions.scoring import MONTHS, clamp

# --- fixed values ------------------------------------------------------------
ALPHA = 0.05
POWER_TARGET = 0.8
DEFAULT_MDE = 0.05
# --- end of fixed values ----------------------------------------------------


def _quantiles(alpha, power, two_sided=True):
    return (tails.normal_quantile(1 - (alpha / 2 if two_sided else alpha)),
            tails.normal_quantile(power))


def check_design(baseline: float, mde: float) -> None:
    if not 0 < baseline < 1:
        raise ValueError(f"baseline rate must be in (0, 1), got {baseline}")
    if mde <= 0:
        raise ValueError(f"effect must be positive, got {mde}")


def _shifted(baseline: Column, mde: Column) -> Column:
    return clamp(baseline + mde, 1e-9, 1 - 1e-9)


def required_n_proportion(baseline: Column, mde: Column, alpha=ALPHA, power=POWER_TARGET,
                          two_sided: bool = True) -> Column:
    """Per-arm size for a rate; the null term is pooled, the alternative is not.

    A design outside (0, 1) or without a positive effect raises when evaluated.
    """
    za, zb = _quantiles(alpha, power, two_sided)
    p2 = _shifted(baseline, mde)
    mid = (baseline + p2) / 2
    root = (F.lit(za) * F.sqrt(2 * mid * (1 - mid))
            + F.lit(zb) * F.sqrt(baseline * (1 - baseline) + p2 * (1 - p2)))
    n = F.ceil(root * root / ((p2 - baseline) * (p2 - baseline)))
    valid = (baseline > 0) & (baseline < 1) & (mde > 0)
    return F.when(valid, n).otherwise(
        F.raise_error(F.lit("baseline must be in (0, 1) and the effect positive")))


def required_n_mean(sd: Column, mde: Column, alpha=ALPHA, power=POWER_TARGET) -> Column:
    za, zb = _quantiles(alpha, power)
    ratio = F.lit(za + zb) * sd / mde
    return F.when(sd > 0, F.ceil(2 * ratio * ratio)).otherwise(
        F.raise_error(F.lit("standard deviation must be positive")))


def detectable_effect(n: Column, baseline: Column, alpha=ALPHA, power=POWER_TARGET) -> Column:
    """Smallest absolute change seen at ``n`` per arm; baseline variance only."""
    za, zb = _quantiles(alpha, power)
    return F.lit(za + zb) * F.sqrt(2 * baseline * (1 - baseline) / n)


def power_at(n: Column, baseline: Column, mde: Column, alpha=ALPHA, two_sided=True) -> Column:
    za, _ = _quantiles(alpha, 0.5, two_sided)
    p2 = _shifted(baseline, mde)
    mid = (baseline + p2) / 2
    null = F.sqrt(2 * mid * (1 - mid) / F.greatest(n, F.lit(1)))
    alt = F.sqrt((baseline * (1 - baseline) + p2 * (1 - p2)) / F.greatest(n, F.lit(1)))
    return F.when(n < 1, F.lit(0.0)).otherwise(
        tails.cdf_normal((F.abs(p2 - baseline) - F.lit(za) * null) / alt))


def design_inputs(targeted: DataFrame, by=(), score: str = "churn_probability") -> DataFrame:
    """Expected retention, arm size and annual revenue deviation per design."""
    return targeted.groupBy(*by).agg(
        (1 - F.avg(score)).alias("baseline_rate"),
        F.floor(F.count("*") / 2).alias("available_n_per_arm"),
        F.stddev_samp(F.col("MonthlyCharges") * MONTHS).alias("revenue_sd"))


def design_table(inputs: DataFrame, mde: float = DEFAULT_MDE, alpha=ALPHA,
                 power=POWER_TARGET) -> DataFrame:
    """Required size and detectable effect beside each design's inputs."""
    base, n = F.col("baseline_rate"), F.col("available_n_per_arm")
    out = inputs.withColumns({
        "mde_absolute": F.lit(mde), "alpha": F.lit(alpha), "power_target": F.lit(power),
        "required_n_per_arm": required_n_proportion(base, F.lit(mde), alpha, power),
        "detectable_mde": F.when(n > 0, detectable_effect(n, base, alpha, power))})
    return out.withColumns({
        "required_n_total": 2 * F.col("required_n_per_arm"),
        "adequately_powered": n >= F.col("required_n_per_arm")})


def power_curve(designs: DataFrame, steps: int = 200, alpha=ALPHA) -> DataFrame:
    """Power over a grid of sizes and three effects for every design row."""
    top = F.greatest(F.floor(F.col("required_n_per_arm") * 1.6), 2 * F.col("available_n_per_arm"), F.lit(51))
    grid = F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.lit(steps - 1)),
        lambda i: F.floor(50 + (top - 50) * i / (steps - 1))))
    out = (designs.withColumn("n_per_arm", F.explode(grid))
           .withColumn("effect", F.explode(F.transform(
               F.array(F.lit(1.0), F.lit(1.5), F.lit(2.0)), lambda m: m * F.col("mde_absolute")))))
    return out.withColumn("power", power_at(
        F.col("n_per_arm"), F.col("baseline_rate"), F.col("effect"), alpha))


def register_design(designs: DataFrame, path: str) -> None:
    """Append designs with their registration time; earlier records stay."""
    store_designs(designs.withColumn("registered_at", F.current_timestamp()), path)


def store_designs(designs: DataFrame, path: str) -> None:
    """Append designs that carry their own ``registered_at``."""
    designs.write.mode("append").parquet(path)


def designs_as_of(designs: DataFrame, outcomes: DataFrame, key: str = "experiment") -> DataFrame:
    """Per experiment the newest design registered before its first outcome, and how many came too late.

    ``outcomes`` has (experiment, first_outcome), a row per experiment; an experiment
    whose designs are all late, or that has none, has a NULL design.
    """
    fields = F.struct("registered_at", *[c for c in designs.columns if c not in (key, "registered_at")])
    held = outcomes.select(key, "first_outcome").join(designs.select(key, "registered_at", fields.alias("_d")), key, "left")
    late = F.col("registered_at") >= F.col("first_outcome")
    newest = F.max_by(F.when(~late, F.col("_d")), F.when(~late, F.col("registered_at")))
    out = held.groupBy(key, "first_outcome").agg(newest.alias("_d"), F.count_if(late).alias("refused"))
    return out.select(key, "first_outcome", "_d.*", "refused")


def registered_design(designs: DataFrame, first_outcome: Column) -> DataFrame:
    """The newest design written before the first outcome of its experiment."""
    before = designs.filter(F.col("registered_at") < first_outcome)
    newest = F.row_number().over(
        Window.partitionBy("experiment").orderBy(F.desc("registered_at")))
    return before.withColumn("_r", newest).filter("_r = 1").drop("_r")


def verdict(joined: DataFrame) -> DataFrame:
    """Read a result against its registered design.

    Expects ``p_value, alpha, required_n_per_arm, available_n_per_arm``.
    """
    significant = F.col("p_value") < F.col("alpha")
    powered = F.col("available_n_per_arm") >= F.col("required_n_per_arm")
    return joined.withColumns({
        "adequately_powered": powered,
        "verdict": F.when(significant, "significant").when(powered, "null").otherwise("inconclusive"),
        "inflation_caveat": significant & ~powered})
