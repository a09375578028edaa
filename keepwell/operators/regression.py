"""Regression from moment matrices.

Rows stay on the executors: a pass over the data produces a k x k matrix of
sums (k is the number of terms), and only that matrix is solved on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from keepwell.functions import tails

ALPHA = 0.05
SUMS_IN_PLAN = 8


def moments(df: DataFrame, terms: Mapping[str, Column], weight: Column | None = None) -> np.ndarray:
    """Weighted cross-product matrix of the terms.

    Rows with a NULL or NaN among the terms or the weight are left out of every
    cell, whatever the width. A few terms are plain sums inside one aggregate.
    Wide designs would make that aggregate too large to compile, so each task
    multiplies its Arrow batches and the partial matrices are added by cell.
    """
    names = list(terms)
    k = len(names)
    w = F.lit(1.0) if weight is None else weight.cast("double")
    columns = ["_w", *[f"x{i}" for i in range(k)]]
    rows = df.select(w.alias("_w"), *[terms[n].cast("double").alias(f"x{i}") for i, n in enumerate(names)])
    rows = rows.filter(reduce(and_, [F.col(c).isNotNull() & ~F.isnan(c) for c in columns]))
    if k <= SUMS_IN_PLAN:
        row = rows.agg(
            *[F.sum(F.col("_w") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"m{i}_{j}")
              for i in range(k) for j in range(i, k)]).first()
        out = np.zeros((k, k))
        for i in range(k):
            for j in range(i, k):
                out[i, j] = out[j, i] = row[f"m{i}_{j}"] or 0.0
        return _finite(out)

    def partial(batches):
        total = np.zeros((k, k))
        for pdf in batches:
            x = pdf[columns[1:]].to_numpy(dtype=float)
            total += x.T @ (x * pdf["_w"].to_numpy(dtype=float)[:, None])
        i, j = np.triu_indices(k)
        yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"), "s": total[i, j]})

    cells = (rows.mapInPandas(partial, "i int, j int, s double")
             .groupBy("i", "j").agg(F.sum("s").alias("s")).collect())
    out = np.zeros((k, k))
    for r in cells:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"]
    return _finite(out)


def _finite(sums: np.ndarray) -> np.ndarray:
    if not np.isfinite(sums).all():
        raise ValueError("the moments of the terms are not finite")
    return sums


@dataclass
class Fit:
    """Coefficients with their covariance; ``table`` turns it into rows."""

    names: list[str]
    beta: np.ndarray
    cov: np.ndarray
    n: float
    dof: float

    @property
    def std_error(self) -> np.ndarray:
        return np.sqrt(np.clip(np.diag(self.cov), 0, None))

    def rows(self) -> list[tuple]:
        se = self.std_error
        dof = float(self.dof)
        crit = tails.t_quantile(1 - ALPHA / 2, dof)
        out = []
        for name, b, s in zip(self.names, self.beta, se):
            t = float(b / s) if s > 0 else 0.0
            p = tails.t_two_sided(t, dof)
            out.append((name, float(b), float(s), t, p, float(b - crit * s), float(b + crit * s), p < ALPHA))
        return out

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame(
            self.rows(), "term string, coefficient double, std_error double, t_statistic double, "
            "p_value double, ci_low double, ci_high double, significant boolean")

    def term(self, name: str) -> dict:
        keys = ["term", "coefficient", "std_error", "t_statistic", "p_value", "ci_low", "ci_high", "significant"]
        return dict(zip(keys, self.rows()[self.names.index(name)]))


def combination(terms: Mapping[str, Column], weights: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for c, w in zip(terms.values(), weights):
        total = total + c.cast("double") * F.lit(float(w))
    return total


def _complete(df: DataFrame, columns) -> DataFrame:
    test = F.lit(True)
    for c in columns:
        test = test & c.isNotNull()
    return df.filter(test)


def _sandwich(df, terms, residual, bread, n, k, weight):
    squared = residual * residual
    meat = moments(df, terms, squared if weight is None else squared * weight)
    return bread @ meat @ bread * (n / max(n - k, 1))


def ols_hc1(df: DataFrame, y: Column, terms: Mapping[str, Column],
            weight: Column | None = None) -> Fit:
    """Least squares with HC1 errors in two passes (``weight`` = row counts)."""
    df = _complete(df, [y, *terms.values()])
    names = list(terms)
    k = len(names)
    m = moments(df, {**terms, "_y": y, "_1": F.lit(1.0)}, weight)
    n = m[k + 1, k + 1]
    bread = np.linalg.pinv(m[:k, :k])
    beta = bread @ m[:k, k]
    cov = _sandwich(df, terms, y - combination(terms, beta), bread, n, k, weight)
    return Fit(names, beta, cov, n, max(n - k, 1))


@dataclass
class TwoStage:
    second: Fit
    first: Fit
    f_statistic: float

    @property
    def weak_instrument(self) -> bool:
        return self.f_statistic < 10


def tsls(df: DataFrame, y: Column, endog: tuple[str, Column], instruments: Mapping[str, Column],
         exog: Mapping[str, Column]) -> TwoStage:
    """Two-stage least squares for one endogenous regressor.

    One moment matrix of all variables gives both stages; the residual pass
    uses the actual regressor, not its projection.
    """
    name, d = endog
    z = {**instruments, **exog}
    df = _complete(df, [y, d, *z.values()])
    q, kz = len(instruments), len(z)
    m = moments(df, {**z, "_d": d, "_y": y, "_1": F.lit(1.0)})
    n = m[-1, -1]
    zz, zd, zy = m[:kz, :kz], m[:kz, kz], m[:kz, kz + 1]
    pi = np.linalg.pinv(zz) @ zd

    # Projected design [d_hat, exog] written as a linear map of z.
    lift = np.zeros((kz, 1 + len(exog)))
    lift[:, 0] = pi
    for j in range(len(exog)):
        lift[q + j, 1 + j] = 1.0
    bread = np.linalg.pinv(lift.T @ zz @ lift)
    beta = bread @ (lift.T @ zy)
    projected = {name: combination(z, pi), **exog}
    actual = {name: d, **exog}
    k = 1 + len(exog)
    cov = _sandwich(df, projected, y - combination(actual, beta), bread, n, k, None)
    second = Fit(list(actual), beta, cov, n, max(n - k, 1))

    first_cov = _sandwich(df, z, d - combination(z, pi), np.linalg.pinv(zz), n, kz, None)
    first = Fit(list(z), pi, first_cov, n, max(n - kz, 1))
    ssr_full = m[kz, kz] - zd @ pi
    ee, ed = zz[q:, q:], zd[q:]
    ssr_restricted = m[kz, kz] - ed @ np.linalg.pinv(ee) @ ed
    f = ((ssr_restricted - ssr_full) / q) / max(ssr_full / max(n - kz, 1), 1e-300)
    return TwoStage(second, first, float(f))


def correlation_matrix(df: DataFrame, terms: Mapping[str, Column]) -> np.ndarray:
    """Correlations from centred moments; a constant column correlates with none."""
    names = list(terms)
    rough = df.agg(*[F.avg(c.cast("double")).alias(f"a{i}") for i, c in enumerate(terms.values())]).first()
    centred = {n: terms[n].cast("double") - F.lit(float(rough[f"a{i}"] or 0.0)) for i, n in enumerate(names)}
    m = moments(_complete(df, list(terms.values())), {**centred, "_1": F.lit(1.0)})
    n, s = m[-1, -1], m[:-1, -1]
    cov = m[:-1, :-1] - np.outer(s, s) / n
    sd = np.sqrt(np.clip(np.diag(cov), 0, None))
    with np.errstate(divide="ignore", invalid="ignore"):
        corr = np.nan_to_num(cov / np.outer(sd, sd), nan=0.0, posinf=0.0, neginf=0.0)
    np.fill_diagonal(corr, 1.0)
    return corr


def variance_inflation(df: DataFrame, terms: Mapping[str, Column]) -> dict[str, float]:
    """Diagonal of the inverse correlation matrix, never below 1."""
    inverse = np.linalg.pinv(correlation_matrix(df, terms))
    return {n: max(float(v), 1.0) for n, v in zip(terms, np.diag(inverse))}
