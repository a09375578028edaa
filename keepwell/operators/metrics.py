"""Classification, agreement and clustering metrics computed by aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from keepwell.operators.ranking import cumulative_by_value


def classification(df: DataFrame, label: str, prediction: str, by=()) -> DataFrame:
    """Precision, recall, F1 and support of the positive class."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(y).alias("support"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    out = counts.withColumns({
        "precision": zero(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))),
        "recall": zero(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")))})
    return out.withColumn("f1_score", zero(F.try_divide(
        2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve with ties counted half."""
    table = cumulative_by_value(df, score, {"w": F.lit(1), "pos": F.col(label).cast("long")})
    return _auc_from(table)


def _auc_from(table: DataFrame) -> DataFrame:
    """Twice the Mann-Whitney statistic is an integer sum over distinct scores."""
    neg, neg_below = F.col("w") - F.col("pos"), F.col("w_below") - F.col("pos_below")
    twice = F.col("pos").cast("decimal(38,0)") * (2 * neg_below + neg)
    return table.agg(
        F.sum("pos").alias("n_positive"), F.sum(neg).alias("n_negative"), F.sum(twice).cast("double").alias("_u2")
    ).select("n_positive", "n_negative", F.try_divide(
        F.col("_u2"), 2.0 * F.col("n_positive") * F.col("n_negative")).alias("roc_auc"))


def score_pairs(df: DataFrame, label: str, a: str, b: str) -> DataFrame:
    """Rows and positives per distinct pair of scores; common pairs cost one row."""
    return (df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b)
            .agg(F.count("*").alias("w"), F.sum(F.col(label).cast("long")).alias("pos")))


def _ranks(table: DataFrame, value: str, rank: str) -> DataFrame:
    return table.select(value, (F.col("w_below") + (F.col("w") + 1) / 2).alias(rank))


def _rank_correlation(pairs: DataFrame, a: str, b: str, ra: DataFrame, rb: DataFrame) -> DataFrame:
    w, x, y = F.col("w"), F.col("ra"), F.col("rb")
    sums = pairs.join(ra, a).join(rb, b).agg(
        F.sum(w).cast("double").alias("n"), F.sum(w * x).alias("sx"), F.sum(w * y).alias("sy"),
        F.sum(w * x * x).alias("sxx"), F.sum(w * y * y).alias("syy"), F.sum(w * x * y).alias("sxy"))
    n = F.col("n")
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / n
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / n
    vy = F.col("syy") - F.col("sy") * F.col("sy") / n
    return sums.select(F.try_divide(cov, F.sqrt(vx * vy)).alias("spearman_rho"))


def score_agreement(df: DataFrame, label: str, first: str, second: str) -> DataFrame:
    """Pearson, Spearman, both AUCs and the mean gap of two score columns.

    Everything follows from the table of distinct score pairs. Each part is
    one row, so the joins below pair single rows.
    """
    pairs = score_pairs(df, label, first, second).persist()
    sums = {"w": F.col("w"), "pos": F.col("pos")}
    of_first, of_second = (cumulative_by_value(pairs, c, sums) for c in (first, second))
    rho = _rank_correlation(pairs, first, second, _ranks(of_first, first, "ra"), _ranks(of_second, second, "rb"))
    w, x, y = F.col("w").cast("double"), F.col(first), F.col(second)
    m = pairs.agg(F.sum(w).alias("n"), F.sum(w * x).alias("sx"), F.sum(w * y).alias("sy"), F.sum(w * x * x).alias("sxx"),
                  F.sum(w * y * y).alias("syy"), F.sum(w * x * y).alias("sxy"), F.sum(w * F.abs(x - y)).alias("gap"))
    n = F.col("n")
    linear = m.select(
        F.try_divide(F.col("sxy") - F.col("sx") * F.col("sy") / n, F.sqrt(
            (F.col("sxx") - F.col("sx") * F.col("sx") / n) * (F.col("syy") - F.col("sy") * F.col("sy") / n))).alias("pearson_r"),
        (F.col("gap") / n).alias("mean_abs_probability_gap"))
    out = (linear.join(rho).join(_auc_from(of_first).select(F.col("roc_auc").alias("first_auc")))
           .join(_auc_from(of_second).select(F.col("roc_auc").alias("second_auc"))))
    return out.withColumns({
        "auc_gap": F.abs(F.col("first_auc") - F.col("second_auc")),
        "ranks_differ": F.col("spearman_rho") < 0.95})


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chance-corrected agreement from the joint count table."""
    joint = df.groupBy(a, b).agg(F.count("*").alias("n"))
    pairs = lambda c: (F.col(c).cast("double") * (F.col(c) - 1) / 2)
    rows = joint.groupBy(a).agg(F.sum("n").alias("n")).agg(F.sum(pairs("n")).alias("sum_a"), F.sum("n").alias("total"))
    cols = joint.groupBy(b).agg(F.sum("n").alias("n")).agg(F.sum(pairs("n")).alias("sum_b"))
    cells = joint.agg(F.sum(pairs("n")).alias("sum_ab"))
    one = rows.join(cols).join(cells)
    expected = F.try_divide(F.col("sum_a") * F.col("sum_b"), pairs("total"))
    best = (F.col("sum_a") + F.col("sum_b")) / 2
    return one.select(F.coalesce(
        F.try_divide(F.col("sum_ab") - expected, best - expected), F.lit(1.0)).alias("adjusted_rand_index"))


QUALITY = ("k int, rows long, inertia double, silhouette double, davies_bouldin double, "
           "calinski_harabasz double, smallest_share double")


def cluster_quality(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Separation indices for a labelling in two passes, without row pairs.

    inertia: squared distance to the own centroid. silhouette: the squared
    Euclidean form, where a row's mean distance to a cluster needs only that
    cluster's count, centroid and mean squared norm. davies_bouldin uses the
    mean Euclidean distance to the centroid. Only those per-cluster numbers
    come to the driver; they return as literals of the second pass.
    """
    columns = list(columns)
    x = [F.col(c).cast("double") for c in columns]
    norm2 = reduce(add, [c * c for c in x])
    stats = df.groupBy(F.col(label).alias("label")).agg(
        F.count("*").alias("n"), F.avg(norm2).alias("s2"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)]).orderBy("label").collect()
    sizes = np.array([float(r["n"]) for r in stats])
    means = np.array([[r[f"m{i}"] for i in range(len(columns))] for r in stats])
    k = len(stats)

    def mean_distance(i):
        dot = reduce(add, [c * F.lit(float(m)) for c, m in zip(x, means[i])])
        return F.col("_n2") + F.lit(float(stats[i]["s2"])) - 2 * dot

    near = df.select(label, *columns, norm2.alias("_n2")).select(
        F.col(label).alias("_k"), *[mean_distance(i).alias(f"d{i}") for i in range(k)])
    own = inner = outer = None
    for i, r in enumerate(stats):
        mine = F.col("_k") == F.lit(r["label"])
        # distance to the own centroid = mean distance - spread of the cluster
        spread = float(r["s2"]) - float(means[i] @ means[i])
        others = [F.col(f"d{j}") for j in range(k) if j != i]
        nearest = F.least(*others) if len(others) > 1 else others[0] if others else F.lit(None)
        step = lambda chain, value: F.when(mine, value) if chain is None else chain.when(mine, value)
        own = step(own, F.greatest(F.col(f"d{i}") - spread, F.lit(0.0)))
        inner = step(inner, F.col(f"d{i}") * (sizes[i] / max(sizes[i] - 1, 1)))
        outer = step(outer, nearest)
    near = near.select("_k", own.alias("own"), inner.alias("a"), outer.alias("b"))
    sil = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    found = {r["_k"]: r for r in near.groupBy("_k").agg(
        F.sum("own").alias("ss"), F.avg(F.sqrt("own")).alias("spread"), F.sum(sil).alias("sil")).collect()}
    ss = np.array([found[r["label"]]["ss"] for r in stats])
    spread = np.array([found[r["label"]]["spread"] for r in stats])
    sil = np.array([found[r["label"]]["sil"] if r["n"] > 1 else 0.0 for r in stats])
    n = sizes.sum()
    centre = sizes @ means / n
    between = float(sizes @ ((means - centre) ** 2).sum(axis=1))
    gaps = np.sqrt(((means[:, None, :] - means[None, :, :]) ** 2).sum(axis=2))
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(gaps > 0, (spread[:, None] + spread[None, :]) / gaps, -np.inf)
    worst = float(ratio.max(axis=1).mean()) if k > 1 else None
    within = float(ss.sum())
    ch = between * (n - k) / (within * (k - 1)) if k > 1 and within > 0 else None
    row = (k, int(n), within, float(sil.sum() / n) if k > 1 else None, worst, None if ch is None else float(ch),
           float(sizes.min() / n))
    return df.sparkSession.createDataFrame([row], QUALITY)


def choose_k(scores: DataFrame, min_share: float = 0.03) -> DataFrame:
    """Best silhouette among k whose smallest cluster is large enough, else among all."""
    eligible = F.col("smallest_share") >= min_share
    usable = F.bool_or(eligible).over(Window.partitionBy())      # one row per k
    pool = scores.withColumns({"eligible": eligible, "_any": usable})
    return pool.agg(F.max_by(F.struct("k", "silhouette", "eligible"), F.when(
        F.col("eligible") | ~F.col("_any"), F.struct("silhouette", -F.col("k")))).alias("b")).select("b.*")
