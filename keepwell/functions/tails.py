"""Normal, Student-t and chi-square tails.

Spark has no built-in error function, so these run as Arrow UDFs. They are
only ever applied to already-aggregated rows (one per test or per term).
"""

import math
from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column, functions as F

NORMAL = NormalDist()


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def normal_quantile(q: float) -> float:
    return NORMAL.inv_cdf(q)


def beta_fraction(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by Lentz's continued fraction."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_fraction(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 400):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            out *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * out


def t_two_sided(t: float, dof: float) -> float:
    if not (math.isfinite(t) and dof > 0):
        return float("nan")
    return beta_fraction(dof / 2.0, 0.5, dof / (dof + t * t))


def t_quantile(q: float, dof: float) -> float:
    """Quantile of Student's t by bisection on the two-sided tail."""
    if q == 0.5:
        return 0.0
    if q < 0.5:
        return -t_quantile(1 - q, dof)
    want = 2 * (1 - q)
    low, high = 0.0, 1.0
    while t_two_sided(high, dof) > want:
        high *= 2
    for _ in range(200):
        mid = 0.5 * (low + high)
        if t_two_sided(mid, dof) > want:
            low = mid
        else:
            high = mid
    return 0.5 * (low + high)


def chi2_tail_one_dof(x: float) -> float:
    return math.erfc(math.sqrt(max(x, 0.0) / 2.0))


def _column(fn, *columns: Column) -> Column:
    """``fn`` over whole rows of complete inputs; anything else is NULL."""
    def over(*series: pd.Series) -> pd.Series:
        return pd.Series([fn(*map(float, row)) if not any(pd.isna(v) for v in row) else None
                          for row in zip(*series)], dtype="float64")

    arity = len(columns)
    if arity == 1:
        def batch(a: pd.Series) -> pd.Series:
            return over(a)
    else:
        def batch(a: pd.Series, b: pd.Series) -> pd.Series:
            return over(a, b)
    value = F.pandas_udf(batch, "double")(*columns)
    return F.nanvl(value, F.lit(None).cast("double"))


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def p_normal(z: Column) -> Column:
    return _column(normal_two_sided, z)


def cdf_normal(x: Column) -> Column:
    return _column(normal_cdf, x)


def p_student(t: Column, dof: Column) -> Column:
    return _column(t_two_sided, t, dof)


def q_student(q: float, dof: Column) -> Column:
    return _column(t_quantile, F.lit(q), dof)


def p_chi2_one(x: Column) -> Column:
    return _column(chi2_tail_one_dof, x)
