"""Odds ratios with Wald intervals and collinearity diagnostics."""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from keepwell.functions import tails
from keepwell.operators.causal import Logistic, fit_logistic
from keepwell.operators.encode import balanced_weight, scaled, scaling
from keepwell.operators.regression import moments, variance_inflation

# --- fixed values ------------------------------------------------------------
ALPHA = 0.05
VIF_WARNING = 10.0
RANK_AGREEMENT = 0.95
# --- end of fixed values ----------------------------------------------------

COEFFICIENTS = ("feature string, coefficient double, std_error double, odds_ratio double, or_ci_low double, "
                "or_ci_high double, z_statistic double, p_value double, standardised_coefficient double, "
                "significant boolean, vif double")


def _exp(value: float) -> float:
    """An odds ratio; beyond the range of doubles it is infinite."""
    return math.exp(value) if value < 709 else math.inf


def fit_inference(df: DataFrame, terms: Mapping[str, Column], target: str) -> Logistic:
    """Unpenalised class-balanced logistic fit on reference-coded terms."""
    return fit_logistic(df, terms, F.col(target), l2=0.0, class_weight=balanced_weight(df, target))


def wald_table(df: DataFrame, terms: Mapping[str, Column], target: str,
               model: Logistic | None = None) -> DataFrame:
    """Odds ratio, interval and VIF per term, strongest first.

    The information matrix is a sum over rows of p(1 - p) x x' (one pass);
    class weights shape the fit but not this matrix.
    """
    model = model or fit_inference(df, terms, target)
    scale = scaling(df, terms)
    z_terms = {"_1": F.lit(1.0), **scaled(terms, scale)}
    p = model.probability
    information = moments(df, z_terms, weight=p * (1 - p))
    se = np.sqrt(np.clip(np.diag(np.linalg.pinv(information)), 0, None))[1:]
    vif = variance_inflation(df, terms)
    crit = tails.normal_quantile(1 - ALPHA / 2)
    rows = []
    for i, name in enumerate(terms):
        sd = scale[name][1]
        raw, raw_se = model.weights.get(name, 0.0), float(se[i]) / sd
        z = raw / raw_se if raw_se > 0 else 0.0
        pv = math.erfc(abs(z) / math.sqrt(2.0))
        rows.append((name, raw, raw_se, _exp(raw), _exp(raw - crit * raw_se), _exp(raw + crit * raw_se),
                     z, pv, raw * sd, pv < ALPHA, vif[name]))
    rows.sort(key=lambda r: -abs(r[1]))
    return df.sparkSession.createDataFrame(rows, COEFFICIENTS)


def headline(table: DataFrame) -> DataFrame:
    """Largest significant effect that is not collinear, else the largest."""
    clean = F.col("significant") & (F.col("vif") <= VIF_WARNING)
    size = F.abs(F.ln("odds_ratio"))
    row = F.struct("feature", "odds_ratio", "or_ci_low", "or_ci_high", "vif")
    return table.agg(F.coalesce(F.max_by(row, F.when(clean, size)), F.max_by(row, size)).alias("r"),
                     F.count_if(F.col("significant")).alias("n_significant"),
                     F.count_if(F.col("vif") > VIF_WARNING).alias("n_high_vif")).select("r.*", "n_significant", "n_high_vif")
