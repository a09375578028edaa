"""The full observational readout of a treatment customers choose."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from keepwell.functions.scoring import logit
from keepwell.operators import causal, matching
from keepwell.session import checkpoint_ready


def refute(units: DataFrame, key: str, observed: float, runs: int = causal.PLACEBO_RUNS, seed=42) -> DataFrame:
    """Placebo and subset refuters; the runs of each are fitted together."""
    numeric, categorical = causal.confounder_columns()
    slim = units.select(key, *numeric, *categorical, "treated", "outcome")
    return causal.refutation(observed, causal.run_effects(causal.placebo_treatments(slim, key, runs, seed), numeric, categorical),
                             causal.run_effects(causal.subset_samples(slim, key, runs, seed), numeric, categorical))


def run_observational(units: DataFrame, key: str, mediators: bool = False, draws: int = 0,
                      seed=42) -> dict[str, DataFrame]:
    """Naive gap, three estimates, overlap, balance and agreement.

    The propensity is fitted on all rows to find the common support and again
    on the kept rows. ``draws`` > 0 adds model-based bootstrap intervals (one
    pair of refits per draw).
    """
    spark = units.sparkSession
    checkpoint_ready(spark)
    numeric, categorical = causal.confounder_columns(mediators)
    columns = numeric + categorical
    naive = causal.naive_difference(units)
    every = causal.design_cells(units, columns).checkpoint()
    first = causal.fit_logistic(every, causal.confounder_terms(every, numeric, categorical), F.col("treated"), F.col("n"))
    with_p = every.withColumn("propensity", first.probability)
    support = causal.overlap(with_p)
    ends = support.first()
    cells = with_p.filter(F.col("propensity").between(ends["low"], ends["high"])).drop("propensity").checkpoint()
    terms = causal.confounder_terms(cells, numeric, categorical)
    fitted = causal.fit_replicates(causal.single(cells, terms), list(terms), 1)
    _, by_weight, robust, effective_size = fitted.weighted()[0]
    if by_weight is None:
        raise ValueError("the propensity has one class on the common support or did not converge")
    second = causal.Logistic(float(fitted.propensity.intercept[0]), dict(zip(terms, map(float, fitted.propensity.weights[0]))), terms)
    weighted = cells.withColumn("propensity", second.probability)
    # stored: otherwise the planner derives constraints from both models in every join of units with pairs
    kept = units.filter(first.probability.between(ends["low"], ends["high"])).withColumn(
        "score", logit(second.probability, causal.LOGIT_CLIP)).persist()
    caliper = matching.caliper_width(kept, "score")
    pairs = matching.match_pairs(kept, key, "score", "treated", caliper, carry=["outcome"], seed=seed).checkpoint()
    effect = matching.att(pairs).first()

    q = causal.clamp(F.col("propensity"), *causal.WEIGHT_CLIP)
    inverse = F.col("n") * F.when(F.col("treated") == 1, 1 / q).otherwise(1 / (1 - q))
    before = causal.standardised_differences(cells, terms, F.col("n"))
    reweighted = causal.standardised_differences(weighted, terms, inverse)
    ids = pairs.select(F.explode(F.array("treated_id", "control_id")).alias(key))
    after = causal.standardised_differences(kept.join(ids, key), terms, F.lit(1.0))
    balance = (before.select("covariate", F.col("smd").alias("before"))
               .join(after.select("covariate", F.col("smd").alias("after_matching")), "covariate")
               .join(reweighted.select("covariate", F.col("smd").alias("after_weighting")), "covariate"))

    intervals = {}
    if draws:
        found = causal.model_bootstrap(cells, terms, [*columns, "treated", "outcome"], draws, seed)
        intervals = {r["estimator"]: r for r in found.collect()}
    values = {"matching_att": effect["att"], "ipw_ate": by_weight, "aipw_ate": robust}
    methods = {"matching_att": "each treated customer with the nearest free control by propensity logit, within 0.2 deviations",
               "ipw_ate": "outcome means weighted by inverse propensity", "aipw_ate": "an outcome model per arm, corrected by weighted residuals"}
    estimates = spark.createDataFrame([
        (k, None if v is None else float(v), intervals[k]["ci_low"] if k in intervals else None,
         intervals[k]["ci_high"] if k in intervals else None, methods[k]) for k, v in values.items()],
        "estimator string, estimate double, ci_low double, ci_high double, note string")
    known = [v for v in values.values() if v is not None]
    gap = naive.first()["naive_difference"]
    rr = (effect["treated_rate"] / effect["control_rate"]) if effect["control_rate"] else None
    diagnostics = spark.createDataFrame(
        [(gap, None if effect["att"] is None else gap - effect["att"], max(known) - min(known),
          bool(max(known) - min(known) < causal.AGREEMENT_SPREAD), rr, effective_size)],
        "naive_difference double, selection_bias_removed double, estimator_spread double, estimators_agree boolean, "
        "risk_ratio double, effective_sample_size double").withColumn("e_value", causal.e_value(F.col("risk_ratio")))
    return {"naive": naive, "estimates": estimates, "overlap": support, "balance": balance,
            "matching": matching.match_info(kept, pairs, "treated", caliper), "diagnostics": diagnostics, "pairs": pairs}
