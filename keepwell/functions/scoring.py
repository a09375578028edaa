"""Row-level expressions on scored customers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: cut points and labels -----------------------------------
HIGH_RISK, MEDIUM_RISK = 0.6, 0.4
DECISION_THRESHOLD = 0.5
MONTHS = 12
# --- end of fixed values ----------------------------------------------------


def risk_category(p: Column, high: float = HIGH_RISK, medium: float = MEDIUM_RISK) -> Column:
    """Serving band, both limits exclusive: exactly 0.6 is Medium, 0.4 is Low."""
    return F.when(p > high, "High").when(p > medium, "Medium").otherwise("Low")


def risk_band_sortable(p: Column) -> Column:
    """Dashboard band, both limits inclusive, with a sort prefix."""
    return (F.when(p >= HIGH_RISK, "1 - High").when(p >= MEDIUM_RISK, "2 - Medium")
            .otherwise("3 - Low"))


def hard_prediction(p: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    return (p >= threshold).cast("int")


def prediction_outcome(prediction: Column, actual: Column) -> Column:
    return (F.when((prediction == 1) & (actual == 1), "true positive")
            .when((prediction == 1) & (actual == 0), "false positive")
            .when((prediction == 0) & (actual == 1), "false negative")
            .otherwise("true negative"))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def logit(p: Column, eps: float = 1e-6) -> Column:
    q = clamp(p, eps, 1 - eps)
    return F.ln(q / (1 - q))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def linear_predictor(terms: Mapping[str, float], intercept: float) -> Column:
    total = F.lit(float(intercept))
    for name, weight in terms.items():
        total = total + F.lit(float(weight)) * F.col(name)
    return total


def direction(value: Column) -> Column:
    return F.when(value >= 0, "increases churn").otherwise("decreases churn")


def strip_prefix(name: Column) -> Column:
    """Drop an encoder prefix such as ``nominal__``."""
    return F.regexp_replace(name, "^[^_]*__", "")


def caption(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def sd_map_text(column: Column) -> Column:
    """``{"a": 1.2}`` as ``a (+1.2 SD)``, entries joined by commas."""
    return F.array_join(
        F.transform(F.map_entries(column),
                    lambda e: F.format_string("%s (%+.1f SD)", e["key"], e["value"])), ", ")


def target_population(df: DataFrame, threshold: float, score: str = "churn_probability") -> DataFrame:
    """Customers scored at or above the threshold; an empty target is an error."""
    chosen = df.filter(F.col(score) >= threshold)
    if not chosen.take(1):
        raise ValueError(f"no customers scored at or above {threshold}")
    return chosen
