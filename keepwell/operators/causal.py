"""Estimators for the effect of a treatment customers choose themselves.

Every estimator reads a table of design cells: rows with the same confounders,
treatment and outcome are one cell with a count ``n``. One partial-aggregated
shuffle builds it; model fits, weights, balance and resampling then work on
cells instead of customers.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from keepwell.functions.features import addon_count, ensure_engineered, is_yes
from keepwell.functions.scoring import clamp, linear_predictor, sigmoid
from keepwell.operators import newton
from keepwell.operators.encode import one_hot_terms, pinned_levels
from keepwell.operators.matching import CALIPER_SD, lines_att
from keepwell.operators.ranking import hash_cuts, seeded_hash
from keepwell.operators.regression import Fit, ols_hc1, tsls
from keepwell.schema import ADDON_SERVICES, TARGET
from keepwell.session import checkpoint_ready, for_iteration

# --- fixed values ------------------------------------------------------------
TREATMENT, TREATED_LEVEL = "TechSupport", "Yes"
CONFOUNDERS_NUMERIC = ["tenure", "num_other_addons"]
CONFOUNDERS_CATEGORICAL = [
    "Contract", "InternetService", "PaymentMethod", "PaperlessBilling",
    "Partner", "Dependents", "SeniorCitizen", "gender", "PhoneService",
    "MultipleLines",
]
MEDIATORS = ["MonthlyCharges"]
SMD_THRESHOLD = 0.1
TRIM = 0.02
WEIGHT_CLIP = (0.01, 0.99)
LOGIT_CLIP = 1e-6
AGREEMENT_SPREAD = 0.03
PLACEBO_RUNS = 12
SUBSET_SHARE = 0.7
BOOTSTRAP_DRAWS, MEDIATOR_DRAWS, MIN_DRAWS = 200, 50, 20
# --- end of fixed values ----------------------------------------------------


def prepare_observational(df: DataFrame) -> DataFrame:
    """Customers who could take the treatment, with treatment and outcome flags.

    The add-on count leaves the treatment itself out.
    """
    df = ensure_engineered(df, ["num_addon_services"])
    others = [c for c in ADDON_SERVICES if c != TREATMENT]
    return df.filter(F.col(TREATMENT).isin("Yes", "No")).withColumns({
        "num_other_addons": addon_count(others).cast("int"),
        "treated": is_yes(TREATMENT, TREATED_LEVEL).cast("int"),
        "outcome": F.col(TARGET).cast("int")})


def naive_difference(df: DataFrame) -> DataFrame:
    """Raw outcome gap of all eligible rows, before any trimming."""
    rate = lambda arm: F.avg(F.when(F.col("treated") == arm, F.col("outcome").cast("double")))
    return df.agg(F.count("*").alias("n"), rate(1).alias("treated_rate"), rate(0).alias("control_rate")
                  ).withColumn("naive_difference", F.col("treated_rate") - F.col("control_rate"))


def confounder_columns(mediators: bool = False) -> tuple[list[str], list[str]]:
    return CONFOUNDERS_NUMERIC + (MEDIATORS if mediators else []), list(CONFOUNDERS_CATEGORICAL)


def design_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns, "treated", "outcome").agg(F.count("*").cast("double").alias("n"))


def confounder_terms(cells: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> dict[str, Column]:
    """Reference-coded design over the cells' columns."""
    dummies = one_hot_terms(pinned_levels(cells, categorical), drop_first=True) if categorical else {}
    return {**{c: F.col(c).cast("double") for c in numeric}, **dummies}


class Logistic:
    """Raw-scale coefficients of a fitted logistic model."""

    def __init__(self, intercept: float, weights: Mapping[str, float], terms: Mapping[str, Column]):
        self.intercept, self.weights, self.terms = intercept, dict(weights), dict(terms)

    @property
    def logit(self) -> Column:
        total = F.lit(self.intercept)
        for name, w in self.weights.items():
            total = total + F.lit(w) * self.terms[name]
        return total

    @property
    def probability(self) -> Column:
        return sigmoid(self.logit)


def fit_logistic(df: DataFrame, terms: Mapping[str, Column], label: Column, weight: Column | None = None,
                 l2: float = 1.0, class_weight: Column | None = None) -> Logistic:
    """Logistic regression on standardised terms, reported on the raw scale.

    ``weight`` counts rows; ``l2`` is the strength on the summed loss (0 for
    an unpenalised fit). Constant terms get no coefficient. Raises if the fit
    has one outcome class or doesn't converge.
    """
    count = F.lit(1.0) if weight is None else weight
    use = count if class_weight is None else count * class_weight
    rows = df.select(F.array(*[e.cast("double") for e in terms.values()]).alias("x"), label.cast("double").alias("y"),
                     count.cast("double").alias("n"), use.cast("double").alias("w")).filter("w > 0")
    rows = for_iteration(rows)

    def read(part):
        y, n, w = (part.column(c).to_numpy()[:, None] for c in ("y", "n", "w"))
        return y * w, w, n

    found = newton.fit_many(rows, list(terms), 1, read, l2)
    rows.unpersist()
    if not found.converged[0] or not np.isnan(found.rate[0]):
        raise ValueError("the logistic fit has one outcome class or did not converge")
    return Logistic(float(found.intercept[0]), dict(zip(found.names, map(float, found.weights[0]))), terms)


def overlap(cells: DataFrame, p: str = "propensity", n: str = "n", trim: float = TRIM) -> DataFrame:
    """Common support of both arms, never wider than [trim, 1 - trim]."""
    of = lambda arm, f: f(F.when(F.col("treated") == arm, F.col(p)))
    ends = cells.agg(
        F.greatest(of(1, F.min), of(0, F.min), F.lit(trim)).alias("low"),
        F.least(of(1, F.max), of(0, F.max), F.lit(1 - trim)).alias("high"))
    kept = F.sum(F.when(F.col(p).between(F.col("low"), F.col("high")), F.col(n)).otherwise(0))
    return (cells.join(F.broadcast(ends)).groupBy("low", "high")
            .agg(F.sum(n).cast("long").alias("n_total"), kept.cast("long").alias("n_in_support"))
            .withColumn("n_dropped", F.col("n_total") - F.col("n_in_support"))
            .withColumn("share_dropped", F.col("n_dropped") / F.col("n_total")))


def trim_to_support(cells: DataFrame, support: DataFrame, p: str = "propensity") -> DataFrame:
    """Keep cells inside the support; both ends belong to it."""
    ends = support.select("low", "high")                      # one row
    return cells.join(F.broadcast(ends), F.col(p).between(F.col("low"), F.col("high"))).drop("low", "high")


def saturated_propensity(cells: DataFrame, columns: Sequence[str], by=()) -> DataFrame:
    """Treated share of each confounder combination, one row per combination.

    Gives ``n_t, n_c, y_t, y_c`` (sizes and outcome sums per arm) and
    ``propensity``: enough for every estimator below.
    """
    arm = lambda a, v: F.sum(F.when(F.col("treated") == a, v).otherwise(0.0))
    n, y = F.col("n"), F.col("n") * F.col("outcome")
    out = cells.groupBy(*by, *columns).agg(
        arm(1, n).alias("n_t"), arm(0, n).alias("n_c"), arm(1, y).alias("y_t"), arm(0, y).alias("y_c"))
    return out.withColumn("propensity", F.col("n_t") / (F.col("n_t") + F.col("n_c")))


def long_arms(wide: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Wide cells as one row per arm: (keep..., treated, n, y)."""
    arms = F.array(
        F.struct(F.lit(1).alias("treated"), F.col("n_t").alias("n"), F.col("y_t").alias("y")),
        F.struct(F.lit(0).alias("treated"), F.col("n_c").alias("n"), F.col("y_c").alias("y")))
    return wide.select(*keep, F.explode(arms).alias("a")).select(*keep, "a.*").filter("n > 0")


def standardised_differences(cells: DataFrame, terms: Mapping[str, Column], weight: Column) -> DataFrame:
    """(covariate, smd): gap of weighted means over the pooled deviation.

    Variances divide by the weight sum; a covariate without spread has 0.
    """
    names = list(terms)
    rows = cells.select("treated", weight.cast("double").alias("_w"),
                        *[terms[c].cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    sums = rows.groupBy("treated").agg(F.sum("_w").alias("w"), *[
        e for i in range(len(names)) for e in (
            F.sum(F.col("_w") * F.col(f"x{i}")).alias(f"s{i}"),
            F.sum(F.col("_w") * F.col(f"x{i}") * F.col(f"x{i}")).alias(f"q{i}"))])
    cell = F.array(*[F.struct(F.lit(c).alias("covariate"), (F.col(f"s{i}") / F.col("w")).alias("m"),
                              (F.col(f"q{i}") / F.col("w")).alias("q")) for i, c in enumerate(names)])
    long = sums.select("treated", F.explode(cell).alias("c")).select("treated", "c.*")
    of = lambda arm, v: F.max(F.when(F.col("treated") == arm, v))
    var = F.greatest(F.col("q") - F.col("m") * F.col("m"), F.lit(0.0))
    return long.groupBy("covariate").agg(
        of(1, F.col("m")).alias("mean_treated"), of(0, F.col("m")).alias("mean_control"),
        F.sqrt((of(1, var) + of(0, var)) / 2).alias("pooled_sd")
    ).withColumn("smd", F.when(F.col("pooled_sd") > 1e-12, (F.col("mean_treated") - F.col("mean_control")) / F.col("pooled_sd")).otherwise(0.0))


def stabilised_weight(p: Column, treated: Column, marginal: Column) -> Column:
    q = clamp(p, *WEIGHT_CLIP)
    return F.when(treated == 1, marginal / q).otherwise((1 - marginal) / (1 - q))


def ipw(arms: DataFrame, by=(), p: str = "propensity") -> DataFrame:
    """Stabilised weighting: effect and effective sample size.

    ``arms`` has (treated, n, y, propensity); the stabilising factor cancels in
    each arm's weighted mean but not in the effective size, so both arms'
    plain sums are kept and combined afterwards.
    """
    q = clamp(F.col(p), *WEIGHT_CLIP)
    t = F.col("treated") == 1
    inv = F.when(t, 1 / q).otherwise(1 / (1 - q))
    total = lambda arm, v: F.sum(F.when(F.col("treated") == arm, v))
    sums = arms.groupBy(*by).agg(
        F.sum("n").alias("n"), total(1, F.col("n")).alias("n1"),
        *[total(a, e).alias(f"{k}{a}") for a in (1, 0) for k, e in {
            "w": F.col("n") * inv, "wy": F.col("y") * inv, "ww": F.col("n") * inv * inv}.items()])
    m = F.col("n1") / F.col("n")
    w = m * F.col("w1") + (1 - m) * F.col("w0")
    ww = m * m * F.col("ww1") + (1 - m) * (1 - m) * F.col("ww0")
    return sums.select(*by, "n", (F.col("wy1") / F.col("w1") - F.col("wy0") / F.col("w0")).alias("ipw_ate"),
                       (w * w / ww).alias("effective_sample_size"))


def aipw_saturated(wide: DataFrame, by=()) -> DataFrame:
    """Doubly robust effect with cell means as the outcome model."""
    q = clamp(F.col("propensity"), *WEIGHT_CLIP)
    n = F.col("n_t") + F.col("n_c")
    m1, m0 = F.col("y_t") / F.col("n_t"), F.col("y_c") / F.col("n_c")
    influence = (n * (m1 - m0) + (F.col("y_t") - F.col("n_t") * m1) / q
                 - (F.col("y_c") - F.col("n_c") * m0) / (1 - q))
    return wide.filter("n_t > 0 and n_c > 0").groupBy(*by).agg(
        (F.sum(influence) / F.sum(n)).alias("aipw_ate"))


def aipw_strata(wide: DataFrame, columns: Sequence[str], p: str = "propensity") -> DataFrame:
    """Doubly robust effect with outcome means per arm in strata coarser than the propensity's cells.

    One row: the effect and the part of it that corrects the outcome model by
    weighted residuals. Strata without both arms are left out.
    """
    columns = list(columns)
    strata = wide.groupBy(*columns).agg(*[F.sum(c).alias(f"_{c}") for c in ("n_t", "n_c", "y_t", "y_c")]).filter("_n_t > 0 and _n_c > 0")
    cells = wide.join(strata.select(*columns, (F.col("_y_t") / F.col("_n_t")).alias("m1"), (F.col("_y_c") / F.col("_n_c")).alias("m0")), columns)
    q, n = clamp(F.col(p), *WEIGHT_CLIP), F.col("n_t") + F.col("n_c")
    residual = (F.col("y_t") - F.col("n_t") * F.col("m1")) / q - (F.col("y_c") - F.col("n_c") * F.col("m0")) / (1 - q)
    return cells.agg((F.sum(n * (F.col("m1") - F.col("m0")) + residual) / F.sum(n)).alias("aipw_ate"), (F.sum(residual) / F.sum(n)).alias("correction"))


def e_value(risk_ratio: Column) -> Column:
    """Confounder strength on the risk-ratio scale needed to explain a result away."""
    rr = F.when(risk_ratio >= 1, risk_ratio).otherwise(F.try_divide(F.lit(1.0), risk_ratio))
    return rr + F.sqrt(rr * (rr - 1))


# --- resampling --------------------------------------------------------------

def replicate_weights(cells: DataFrame, terms: Mapping[str, Column], key: Sequence[str], draws: int, seed) -> DataFrame:
    """Cells with all their redrawn counts: (x, treated, outcome, w), w an array of ``draws`` counts.

    A row-level Poisson(1) bootstrap summed over a cell of n rows is
    Poisson(n), so a replicate costs one draw per cell, not per customer. The
    generator is keyed by the cell itself: partitioning cannot change a draw.
    """
    tagged = cells.select(F.array(*[e.cast("double") for e in terms.values()]).alias("x"), "treated", "outcome", "n", _cell_tag(key, seed).alias("tag"))

    def redraw(batches):
        for b in batches:
            w = np.array([np.random.Generator(np.random.Philox(key=t)).poisson(c, draws) for t, c in zip(b.column("tag").to_pylist(), b.column("n").to_pylist())], np.int32)
            lists = pa.ListArray.from_arrays(np.arange(0, w.size + 1, draws, dtype=np.int32), w.ravel())
            yield pa.RecordBatch.from_arrays([b.column("x"), b.column("treated"), b.column("outcome"), lists], names=["x", "treated", "outcome", "w"])

    return tagged.mapInArrow(redraw, "x array<double>, treated int, outcome int, w array<int>")


def _read_cells(part):
    """Treatment, outcome (as columns) and weights (a column per replicate) of a block of cells."""
    t, y = (part.column(c).to_numpy(zero_copy_only=False).astype(float)[:, None] for c in ("treated", "outcome"))
    return t, y, newton.matrix(part.column("w"), part.num_rows)


def _propensity(part):
    t, _, w = _read_cells(part)
    return w * t, w, w


def _outcome_by_arm(part):
    """Two models per replicate, controls first; the penalty is scaled on both arms together."""
    t, y, w = _read_cells(part)
    totals = np.hstack([w * (1 - t), w * t])
    return totals * y, totals, np.hstack([w, w])


@dataclass
class Replicates:
    """Propensity and outcome models of all replicates of a design."""

    cells: DataFrame
    draws: int
    propensity: newton.Fits
    outcome: newton.Fits | None

    def weighted(self) -> list[tuple]:
        """(replicate, ipw_ate, aipw_ate, effective_sample_size), None where a fit failed."""
        p, o, r, clip = self.propensity, self.outcome, self.draws, WEIGHT_CLIP

        def values(part, x):
            t, y, w = _read_cells(part)
            q = np.clip(p.probability(x), *clip)
            up, down = w * t / q, w * (1 - t) / (1 - q)
            out = [w, w * t, up, up * y, down, down * y, w * t / (q * q), w * (1 - t) / ((1 - q) * (1 - q))]
            if o is not None:
                m = o.probability(x)
                out.append(w * (m[:, r:] - m[:, :r] + t * (y - m[:, r:]) / q - (1 - t) * (y - m[:, :r]) / (1 - q)))
            return np.column_stack([v.sum(axis=0) for v in out])

        with np.errstate(invalid="ignore", divide="ignore"):
            n, treated, w1, y1, w0, y0, ww1, ww0, *influence = newton.summed(self.cells, r, values).T
            share = treated / n
            total = share * w1 + (1 - share) * w0
            size = total * total / (share * share * ww1 + (1 - share) ** 2 * ww0)
            effects = (y1 / w1 - y0 / w0, influence[0] / n if influence else np.full(r, np.nan), size)
        usable = np.isnan(p.rate) & p.converged
        return [(i, *(float(e[i]) if usable[i] and np.isfinite(e[i]) else None for e in effects)) for i in range(r)]

    def lines(self) -> DataFrame:
        """Score lines of all replicates: (replicate, score, n_t, n_c, y_t, y_c)."""
        p, draws = self.propensity, self.draws
        usable = np.isnan(p.rate) & p.converged

        def emit(batches):
            for part, x in newton.blocks(batches, draws):
                t, y, w = _read_cells(part)
                q = np.clip(p.probability(x), LOGIT_CLIP, 1 - LOGIT_CLIP)
                # equal designs get equal scores, in whatever block they are multiplied
                score = np.round(np.log(q / (1 - q)), 12)
                row, replicate = np.nonzero((w > 0) & usable[None, :])
                n, t, y = w[row, replicate], t[row, 0], y[row, 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(replicate, pa.int32()), *map(pa.array, (score[row, replicate], n * t, n * (1 - t), n * t * y, n * (1 - t) * y))],
                    names=["replicate", "score", "n_t", "n_c", "y_t", "y_c"])

        return self.cells.mapInArrow(emit, "replicate int, score double, n_t double, n_c double, y_t double, y_c double")

    def matched(self, caliper_sd: float = CALIPER_SD) -> DataFrame:
        return lines_att(self.lines(), ["replicate"], caliper_sd)


def fit_replicates(weighted: DataFrame, names: Sequence[str], draws: int, outcomes: bool = True) -> Replicates:
    """All models of all replicates; the cells with their weights are written once."""
    checkpoint_ready(weighted.sparkSession)
    cells = weighted.checkpoint()
    propensity = newton.fit_many(cells, names, draws, _propensity)
    return Replicates(cells, draws, propensity, newton.fit_many(cells, names, 2 * draws, _outcome_by_arm) if outcomes else None)


def single(cells: DataFrame, terms: Mapping[str, Column], n: str = "n") -> DataFrame:
    """The design itself as its only replicate."""
    return cells.select(F.array(*[e.cast("double") for e in terms.values()]).alias("x"), "treated", "outcome", F.array(n).alias("w"))


def model_bootstrap(cells: DataFrame, terms: Mapping[str, Column], key: Sequence[str], draws: int = BOOTSTRAP_DRAWS, seed=42,
                    caliper_sd: float = CALIPER_SD) -> DataFrame:
    """Intervals of the three estimators, the propensity and outcome models refitted in every draw."""
    fitted = fit_replicates(replicate_weights(cells, terms, key, draws, seed), list(terms), draws)
    spark = cells.sparkSession
    rows = spark.createDataFrame(fitted.weighted(), "replicate int, ipw_ate double, aipw_ate double, effective_sample_size double")
    return reduce(DataFrame.unionByName, [
        percentile_interval(rows, "ipw_ate"), percentile_interval(rows, "aipw_ate"), percentile_interval(fitted.matched(caliper_sd), "matching_att")])


def score_equations(fitted: Replicates, l2: float = 1.0) -> DataFrame:
    """(replicate, term, residual): what is left of each propensity model's score equation, by plain column sums.

    The residual is the derivative of the penalised loss per row of weight, so it is 0 at the fit.
    """
    p = fitted.propensity
    models = fitted.cells.sparkSession.createDataFrame(
        [(i, float(p.intercept[i]), [float(b) for b in p.weights[i]]) for i in range(fitted.draws)], "replicate int, intercept double, beta array<double>")
    rows = fitted.cells.select("x", "treated", F.posexplode("w").alias("replicate", "n")).filter("n > 0").join(F.broadcast(models), "replicate")
    eta = F.col("intercept") + F.aggregate(F.zip_with("x", "beta", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    rows = rows.withColumn("gap", F.col("n") * (F.col("treated") - sigmoid(eta)))
    v = [F.col("x")[i] for i in range(len(p.names))]
    sums = rows.groupBy("replicate").agg(F.sum("gap").alias("g"), F.sum("n").alias("n"), F.first("beta").alias("beta"), *[
        e for i, x in enumerate(v) for e in (F.sum(F.col("gap") * x).alias(f"g{i}"), F.sum(F.col("n") * x).alias(f"s{i}"), F.sum(F.col("n") * x * x).alias(f"q{i}"))])

    def left(i):
        """On the raw scale a ridge on standardised coefficients is l2 x variance x coefficient."""
        mean = F.col(f"s{i}") / F.col("n")
        return (F.col(f"g{i}") - l2 * (F.col(f"q{i}") / F.col("n") - mean * mean) * F.col("beta")[i]) / F.col("n")

    cells = [F.struct(F.lit("intercept").alias("term"), (F.col("g") / F.col("n")).alias("residual"))]
    cells += [F.struct(F.lit(name).alias("term"), left(i).alias("residual")) for i, name in enumerate(p.names)]
    return sums.select("replicate", F.explode(F.array(*cells)).alias("e")).select("replicate", "e.*")


# --- resampling --------------------------------------------------------------

def replicate_weights(cells: DataFrame, terms: Mapping[str, Column], key: Sequence[str], draws: int, seed) -> DataFrame:
    """Cells with all their redrawn counts: (x, treated, outcome, w), w an array of ``draws`` counts.

    A row-level Poisson(1) bootstrap summed over a cell of n rows is
    Poisson(n), so a replicate costs one draw per cell, not per customer. The
    generator is keyed by the cell itself: partitioning cannot change a draw.
    """
    tagged = cells.select(F.array(*[e.cast("double") for e in terms.values()]).alias("x"), "treated", "outcome", "n", _cell_tag(key, seed).alias("tag"))

    def redraw(batches):
        for b in batches:
            w = np.array([np.random.Generator(np.random.Philox(key=t)).poisson(c, draws) for t, c in zip(b.column("tag").to_pylist(), b.column("n").to_pylist())], np.int32)
            lists = pa.ListArray.from_arrays(np.arange(0, w.size + 1, draws, dtype=np.int32), w.ravel())
            yield pa.RecordBatch.from_arrays([b.column("x"), b.column("treated"), b.column("outcome"), lists], names=["x", "treated", "outcome", "w"])

    return tagged.mapInArrow(redraw, "x array<double>, treated int, outcome int, w array<int>")


def _read_cells(part):
    """Treatment, outcome (as columns) and weights (a column per replicate) of a block of cells."""
    t, y = (part.column(c).to_numpy(zero_copy_only=False).astype(float)[:, None] for c in ("treated", "outcome"))
    return t, y, newton.matrix(part.column("w"), part.num_rows)


def _propensity(part):
    t, _, w = _read_cells(part)
    return w * t, w, w


def _outcome_by_arm(part):
    """Two models per replicate, controls first; the penalty is scaled on both arms together."""
    t, y, w = _read_cells(part)
    totals = np.hstack([w * (1 - t), w * t])
    return totals * y, totals, np.hstack([w, w])


@dataclass
class Replicates:
    """Propensity and outcome models of all replicates of a design."""

    cells: DataFrame
    draws: int
    propensity: newton.Fits
    outcome: newton.Fits | None

    def weighted(self) -> list[tuple]:
        """(replicate, ipw_ate, aipw_ate, effective_sample_size), None where a fit failed."""
        p, o, r, clip = self.propensity, self.outcome, self.draws, WEIGHT_CLIP

        def values(part, x):
            t, y, w = _read_cells(part)
            q = np.clip(p.probability(x), *clip)
            up, down = w * t / q, w * (1 - t) / (1 - q)
            out = [w, w * t, up, up * y, down, down * y, w * t / (q * q), w * (1 - t) / ((1 - q) * (1 - q))]
            if o is not None:
                m = o.probability(x)
                out.append(w * (m[:, r:] - m[:, :r] + t * (y - m[:, r:]) / q - (1 - t) * (y - m[:, :r]) / (1 - q)))
            return np.column_stack([v.sum(axis=0) for v in out])

        with np.errstate(invalid="ignore", divide="ignore"):
            n, treated, w1, y1, w0, y0, ww1, ww0, *influence = newton.summed(self.cells, r, values).T
            share = treated / n
            total = share * w1 + (1 - share) * w0
            size = total * total / (share * share * ww1 + (1 - share) ** 2 * ww0)
            effects = (y1 / w1 - y0 / w0, influence[0] / n if influence else np.full(r, np.nan), size)
        usable = np.isnan(p.rate) & p.converged
        return [(i, *(float(e[i]) if usable[i] and np.isfinite(e[i]) else None for e in effects)) for i in range(r)]

    def lines(self) -> DataFrame:
        """Score lines of all replicates: (replicate, score, n_t, n_c, y_t, y_c)."""
        p, draws = self.propensity, self.draws
        usable = np.isnan(p.rate) & p.converged

        def emit(batches):
            for part, x in newton.blocks(batches, draws):
                t, y, w = _read_cells(part)
                q = np.clip(p.probability(x), LOGIT_CLIP, 1 - LOGIT_CLIP)
                # equal designs get equal scores, in whatever block they are multiplied
                score = np.round(np.log(q / (1 - q)), 12)
                row, replicate = np.nonzero((w > 0) & usable[None, :])
                n, t, y = w[row, replicate], t[row, 0], y[row, 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(replicate, pa.int32()), *map(pa.array, (score[row, replicate], n * t, n * (1 - t), n * t * y, n * (1 - t) * y))],
                    names=["replicate", "score", "n_t", "n_c", "y_t", "y_c"])

        return self.cells.mapInArrow(emit, "replicate int, score double, n_t double, n_c double, y_t double, y_c double")

    def matched(self, caliper_sd: float = CALIPER_SD) -> DataFrame:
        return lines_att(self.lines(), ["replicate"], caliper_sd)


def fit_replicates(weighted: DataFrame, names: Sequence[str], draws: int, outcomes: bool = True) -> Replicates:
    """All models of all replicates; the cells with their weights are written once."""
    checkpoint_ready(weighted.sparkSession)
    cells = weighted.checkpoint()
    propensity = newton.fit_many(cells, names, draws, _propensity)
    return Replicates(cells, draws, propensity, newton.fit_many(cells, names, 2 * draws, _outcome_by_arm) if outcomes else None)


def single(cells: DataFrame, terms: Mapping[str, Column], n: str = "n") -> DataFrame:
    """The design itself as its only replicate."""
    return cells.select(F.array(*[e.cast("double") for e in terms.values()]).alias("x"), "treated", "outcome", F.array(n).alias("w"))


def model_bootstrap(cells: DataFrame, terms: Mapping[str, Column], key: Sequence[str], draws: int = BOOTSTRAP_DRAWS, seed=42,
                    caliper_sd: float = CALIPER_SD) -> DataFrame:
    """Intervals of the three estimators, the propensity and outcome models refitted in every draw."""
    fitted = fit_replicates(replicate_weights(cells, terms, key, draws, seed), list(terms), draws)
    spark = cells.sparkSession
    rows = spark.createDataFrame(fitted.weighted(), "replicate int, ipw_ate double, aipw_ate double, effective_sample_size double")
    return reduce(DataFrame.unionByName, [
        percentile_interval(rows, "ipw_ate"), percentile_interval(rows, "aipw_ate"), percentile_interval(fitted.matched(caliper_sd), "matching_att")])


def score_equations(fitted: Replicates, l2: float = 1.0) -> DataFrame:
    """(replicate, term, residual): what is left of each propensity model's score equation, by plain column sums.

    The residual is the derivative of the penalised loss per row of weight, so it is 0 at the fit.
    """
    p = fitted.propensity
    models = fitted.cells.sparkSession.createDataFrame(
        [(i, float(p.intercept[i]), [float(b) for b in p.weights[i]]) for i in range(fitted.draws)], "replicate int, intercept double, beta array<double>")
    rows = fitted.cells.select("x", "treated", F.posexplode("w").alias("replicate", "n")).filter("n > 0").join(F.broadcast(models), "replicate")
    eta = F.col("intercept") + F.aggregate(F.zip_with("x", "beta", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    rows = rows.withColumn("gap", F.col("n") * (F.col("treated") - sigmoid(eta)))
    long = rows.select("replicate", "n", "gap", F.posexplode("x").alias("place", "v"), "beta")
    sums = long.groupBy("replicate", "place").agg(
        F.sum(F.col("gap") * F.col("v")).alias("g"), F.sum("gap").alias("g0"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("v")).alias("s"),
        F.sum(F.col("n") * F.col("v") * F.col("v")).alias("q"), F.max(F.col("beta")[F.col("place")]).alias("b"))
    variance = F.col("q") / F.col("n") - (F.col("s") / F.col("n")) * (F.col("s") / F.col("n"))
    names = F.array(*[F.lit(c) for c in p.names])
    # on the raw scale a ridge on standardised coefficients is l2 x variance x coefficient, about the centred term
    centred = F.col("g") - F.col("g0") * F.col("s") / F.col("n")
    return sums.select("replicate", F.get(names, F.col("place")).alias("term"), ((centred - l2 * variance * F.col("b")) / F.col("n")).alias("residual"))


# --- resampling --------------------------------------------------------------

def _cell_tag(key: Sequence[str], seed) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed)))), 1, 15), 16, 10).cast("long")


def poisson_replicates(cells: DataFrame, key: Sequence[str], draws: int, seed, n: str = "n") -> DataFrame:
    """One row per cell and replicate with a redrawn count.

    A row-level Poisson(1) bootstrap summed over a cell of n rows is
    Poisson(n), so a replicate costs one draw per cell, not per customer. The
    generator is keyed by the cell itself: partitioning cannot change a draw.
    """
    tagged = cells.withColumn("_tag", _cell_tag(key, seed))
    schema = T.StructType([*cells.schema.fields, T.StructField("replicate", T.IntegerType())])

    def redraw(batches):
        for pdf in batches:
            counts = np.vstack([
                np.random.Generator(np.random.Philox(key=int(t))).poisson(float(c), draws)
                for t, c in zip(pdf["_tag"], pdf[n])]) if len(pdf) else np.zeros((0, draws))
            body = pdf.drop(columns="_tag")
            out = body.loc[body.index.repeat(draws)].reset_index(drop=True)
            out[n] = counts.reshape(-1).astype(float)
            out["replicate"] = np.tile(np.arange(draws, dtype="int32"), len(body))
            yield out[out[n] > 0]

    return tagged.mapInPandas(redraw, schema)


def line_att(lines: DataFrame, by: Sequence[str], caliper_sd: float) -> DataFrame:
    """Matched effect per replicate from collapsed cells.

    ``lines`` has (by..., propensity, n_t, n_c, y_t, y_c). Units of equal score
    count with their mean outcome.
    """
    score = F.log(clamp(F.col("propensity"), LOGIT_CLIP, 1 - LOGIT_CLIP) / (1 - clamp(F.col("propensity"), LOGIT_CLIP, 1 - LOGIT_CLIP)))
    return lines_att(lines.withColumn("score", score), by, caliper_sd)


def percentile_interval(draws: DataFrame, value: str) -> DataFrame:
    """95% percentile interval and population deviation of finite draws.

    Fewer than twenty finite draws give NULL. There is one row per replicate.
    """
    v = F.when(~F.isnan(value), F.col(value))
    enough = F.count(v) >= MIN_DRAWS
    ends = F.percentile(v, F.array(F.lit(0.025), F.lit(0.975)))
    return draws.agg(
        F.count(v).alias("draws"),
        F.when(enough, ends[0]).alias("ci_low"), F.when(enough, ends[1]).alias("ci_high"),
        F.when(enough, F.stddev_pop(v)).alias("bootstrap_se")).withColumn("estimator", F.lit(value))


def bootstrap(cells: DataFrame, columns: Sequence[str], draws: int = BOOTSTRAP_DRAWS, seed=42,
              caliper_sd: float = 0.2) -> DataFrame:
    """Intervals of the three estimators with a saturated propensity.

    All replicates run together; the replicate is just a grouping column.
    """
    replicates = poisson_replicates(cells, [*columns, "treated", "outcome"], draws, seed)
    wide = saturated_propensity(replicates, columns, by=["replicate"]).filter(
        F.col("propensity").between(TRIM, 1 - TRIM))
    weighted = ipw(long_arms(wide, ["replicate", "propensity"]), by=["replicate"]).select("replicate", "ipw_ate")
    robust = aipw_saturated(wide, by=["replicate"])
    matched = line_att(wide, ["replicate"], caliper_sd)
    frames = [percentile_interval(weighted, "ipw_ate"), percentile_interval(robust, "aipw_ate"),
              percentile_interval(matched, "matching_att")]
    return reduce(DataFrame.unionByName, frames)


def bootstrap_with(estimator, cells: DataFrame, key: Sequence[str], draws: int, seed=42) -> DataFrame:
    """Interval for any callable ``cells -> float``, one refit per replicate.

    The redrawn cells are checkpointed once; the callable sees the cells of a
    single replicate with their new counts.
    """
    checkpoint_ready(cells.sparkSession)
    replicates = poisson_replicates(cells, key, draws, seed).checkpoint()
    values = []
    for r in range(draws):
        value = estimator(replicates.filter(F.col("replicate") == r).drop("replicate"))
        values.append((r, None if value is None or not np.isfinite(value) else float(value)))
    frame = cells.sparkSession.createDataFrame(values, "replicate int, effect double")
    return percentile_interval(frame, "effect")


def _run_hashes(key: str, runs: int, seed) -> list[Column]:
    return [seeded_hash(F.concat_ws("#", F.col(key), F.lit(str(r))), seed) for r in range(runs)]


def placebo_treatments(units: DataFrame, key: str, runs: int, seed) -> DataFrame:
    """Adds ``arms``: for every run a permuted treatment.

    The ``n_treated`` units with the smallest hashes of the run are treated, so
    every run keeps the exact number; units are flagged where they lie.
    """
    n_treated = units.agg(F.sum("treated").alias("t")).first()["t"] or 0
    hashes = _run_hashes(key, runs, seed)
    cuts = hash_cuts(units, hashes, lambda n: [n_treated])
    return units.withColumn("arms", F.array(*[cuts.below(h, i).cast("int") for i, h in enumerate(hashes)]))


def subset_samples(units: DataFrame, key: str, runs: int, seed, share: float = SUBSET_SHARE) -> DataFrame:
    """Adds ``w``: for every run 1 if the unit is in its exact-size sample without replacement, else 0."""
    hashes = _run_hashes(key, runs, seed)
    cuts = hash_cuts(units, hashes, lambda n: [math.floor(share * n)])
    return units.withColumn("w", F.array(*[cuts.below(h, i).cast("int") for i, h in enumerate(hashes)]))


def run_effects(units: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), caliper_sd: float = CALIPER_SD) -> DataFrame:
    """Matched effect of every run, a logistic propensity refitted in each: (run, n_pairs, matching_att).

    Units carry the treatments (``arms``) or the weights (``w``) of all runs and
    collapse to cells that hold the counts of all runs.
    """
    columns, name = [*numeric, *categorical], "arms" if "arms" in units.columns else "w"
    runs = units.agg(F.max(F.size(name))).first()[0] or 0
    if not runs:
        return units.sparkSession.createDataFrame([], "run int, n_pairs double, matching_att double")
    total = lambda e: F.array(*[F.sum(e(F.col(name)[r])).cast("int") for r in range(runs)])
    if name == "arms":
        both = units.groupBy(*columns, "outcome").agg(total(lambda a: a).alias("t"), total(lambda a: 1 - a).alias("c"))
        arm = F.explode(F.array(*[F.struct(F.lit(a).alias("treated"), F.col(v).alias("w")) for a, v in ((1, "t"), (0, "c"))]))
        cells = both.select(*columns, "outcome", arm.alias("a")).select(*columns, "outcome", "a.*").persist()
    else:
        cells = units.groupBy(*columns, "treated", "outcome").agg(total(lambda w: w).alias("w")).persist()
    terms = confounder_terms(cells, numeric, categorical)
    design = cells.select(F.array(*[e.cast("double") for e in terms.values()]).alias("x"), "treated", "outcome", "w")
    fitted = fit_replicates(design, list(terms), runs, outcomes=False)
    cells.unpersist()
    return fitted.matched(caliper_sd).withColumnRenamed("replicate", "run")


def refutation(observed: float, placebo: DataFrame, subset: DataFrame) -> DataFrame:
    """Pass rules for both refuters; ``placebo``/``subset`` have one row per run."""
    summary = lambda d: d.agg(F.count("matching_att").alias("n"), F.avg("matching_att").alias("m"),
                              F.stddev_pop("matching_att").alias("s"))
    p = summary(placebo).withColumns({
        "refuter": F.lit("placebo_treatment"),
        "passes": F.abs("m") < F.greatest(F.lit(0.02), 2 * F.col("s") / F.sqrt(F.greatest("n", F.lit(1)))),
        "well_separated": F.abs(F.lit(observed) - F.col("m")) > 3 * F.when(F.col("s") > 0, F.col("s")).otherwise(1e-9)})
    s = summary(subset).withColumns({
        "refuter": F.lit("random_subset"),
        "passes": F.abs(F.col("m") - F.lit(observed)) < F.greatest(F.lit(0.02), 2 * F.col("s")),
        "well_separated": F.lit(None).cast("boolean")})
    return p.unionByName(s).select(
        "refuter", F.col("n").alias("n_runs"), F.col("m").alias("mean_estimate"), F.col("s").alias("sd"),
        "passes", "well_separated")


# --- instruments and panels --------------------------------------------------

def instrument_readout(df: DataFrame, y: str = "churned", d: str = "redeemed", z: str = "offered") -> DataFrame:
    """Naive gap, intention to treat, first stage, Wald ratio and 2SLS."""
    one = {"const": F.lit(1.0)}
    naive = ols_hc1(df, F.col(y), {d: F.col(d), **one})
    itt = ols_hc1(df, F.col(y), {z: F.col(z), **one})
    both = tsls(df, F.col(y), (d, F.col(d)), {z: F.col(z)}, one)
    compliance = both.first.term(z)["coefficient"]
    late = itt.term(z)["coefficient"] / compliance if compliance else None
    rows = []
    for name, fit, term in (("naive_ols", naive, d), ("intention_to_treat", itt, z),
                            ("first_stage", both.first, z), ("two_stage_least_squares", both.second, d)):
        t = fit.term(term)
        rows.append((name, t["coefficient"], t["std_error"], t["t_statistic"], t["p_value"], t["ci_low"],
                     t["ci_high"], t["significant"], int(fit.n), both.f_statistic if name == "first_stage" else None,
                     both.weak_instrument if name == "first_stage" else None))
    rows.append(("wald_late", late, *[None] * 6, int(naive.n), None, None))
    return df.sparkSession.createDataFrame(
        rows, "estimator string, estimate double, std_error double, t_statistic double, p_value double, "
        "ci_low double, ci_high double, significant boolean, n long, f_statistic double, weak_instrument boolean")


def panel_cells(panel: DataFrame) -> DataFrame:
    """Cell means of the two periods around treatment and their differences."""
    mean = lambda g, p: F.avg(F.when((F.col("treated_group") == g) & (F.col("post") == p), F.col("churned").cast("double")))
    cells = panel.filter(F.col("period").isin(-1, 0)).agg(
        mean(1, 0).alias("treated_pre"), mean(1, 1).alias("treated_post"),
        mean(0, 0).alias("control_pre"), mean(0, 1).alias("control_post"))
    return cells.withColumns({
        "treated_change": F.col("treated_post") - F.col("treated_pre"),
        "control_change": F.col("control_post") - F.col("control_pre"),
        "naive_post_period": F.col("treated_post") - F.col("control_post"),
    }).withColumn("did_estimate", F.col("treated_change") - F.col("control_change"))


def _interaction(panel: DataFrame, second: str, name: str) -> Fit:
    g, t = F.col("treated_group").cast("double"), F.col(second).cast("double")
    # Rows with equal regressors and outcome are one weighted cell.
    cells = panel.groupBy("treated_group", second, "churned").agg(F.count("*").cast("double").alias("n"))
    return ols_hc1(cells, F.col("churned"), {"const": F.lit(1.0), "treated_group": g, second: t, name: g * t},
                   weight=F.col("n"))


def did_regression(panel: DataFrame) -> Fit:
    """Saturated two-period interaction with robust errors."""
    return _interaction(panel.filter(F.col("period").isin(-1, 0)), "post", "did")


def pre_period_gaps(panel: DataFrame) -> DataFrame:
    mean = lambda g: F.avg(F.when(F.col("treated_group") == g, F.col("churned").cast("double")))
    return panel.filter("period < 0").groupBy("period").agg((mean(1) - mean(0)).alias("gap"))


def parallel_trends(panel: DataFrame) -> DataFrame:
    """Pre-treatment drift of the gap; not testable with fewer than two periods."""
    pre = panel.filter("period < 0")
    gaps = pre_period_gaps(panel).agg(F.count("*").alias("pre_periods"),
                                      (F.max("gap") - F.min("gap")).alias("gap_drift"))
    if gaps.first()["pre_periods"] < 2:
        return gaps.select("pre_periods", F.lit(False).alias("testable"), "gap_drift",
                           *[F.lit(None).cast("double").alias(c) for c in ("interaction", "std_error", "t_statistic", "p_value")],
                           F.lit(None).cast("boolean").alias("trends_parallel"))
    term = _interaction(pre, "period", "pre_trend").term("pre_trend")
    return gaps.select("pre_periods", F.lit(True).alias("testable"), "gap_drift",
                       F.lit(term["coefficient"]).alias("interaction"), F.lit(term["std_error"]).alias("std_error"),
                       F.lit(term["t_statistic"]).alias("t_statistic"), F.lit(term["p_value"]).alias("p_value"),
                       F.lit(not term["significant"]).alias("trends_parallel"))
