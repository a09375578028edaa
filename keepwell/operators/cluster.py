"""K-means segmentation: sweep, choice, stability and projection."""

from __future__ import annotations

import math

from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from keepwell.operators import lloyd, metrics
from keepwell.operators.encode import scaled, scaling
from keepwell.operators.ranking import hash_cuts, seeded_hash
from keepwell.operators.segments import CLUSTER_INPUTS
from keepwell.session import for_iteration

# --- fixed values ------------------------------------------------------------
K_RANGE = range(2, 11)
MIN_SHARE = 0.03
RESTARTS, RESAMPLE_RESTARTS = 20, 10
RESAMPLES, RESAMPLE_SHARE = 25, 0.8
STABLE_ARI = 0.5
SHIFT = 100.0
# --- end of fixed values ----------------------------------------------------

#: Centres a row is compared with at the cost of a row of a small fit, and the work of a row that is labelled by columns.
CENTRES, LABELLING = 16, 25


def standardised(matrix: DataFrame, keep=(), inputs=CLUSTER_INPUTS) -> DataFrame:
    """Population-scaled inputs beside the kept columns, with a vector column."""
    terms = {c: F.col(c) for c in inputs}
    z = scaled(terms, scaling(matrix, terms))
    wide = matrix.select(*keep, *[e.alias(n) for n, e in z.items()])
    return VectorAssembler(inputCols=list(inputs), outputCol="features").transform(wide)


def model_rows(points: DataFrame, models: list[lloyd.Model], inputs=CLUSTER_INPUTS, samples: list | None = None) -> DataFrame:
    """What fits read: the inputs, a hash of the row and the samples it is in."""
    plain = [f.name for f in points.schema if f.name != "features"]
    extra = [F.array(*samples).alias("w")] if samples else []
    rows = points.select(F.array(*[F.col(c).cast("double") for c in inputs]).alias("x"), F.xxhash64(*plain).alias("h"), *extra)
    return for_iteration(rows, work=max(1, sum(m.k for m in models) // CENTRES))


def fit_kmeans(points: DataFrame, k: int, restarts: int = 1, seed: int = 42, inputs=CLUSTER_INPUTS) -> lloyd.Fitted:
    """Lowest-cost model over several seeded starts, fitted together."""
    models = [lloyd.Model(k, i) for i in range(restarts)]
    rows = model_rows(points, models, inputs)
    fits = lloyd.fit_models(rows, models, len(inputs), seed)
    rows.unpersist()
    return lloyd.best_of(fits)


def sweep_models(points: DataFrame, ks=K_RANGE, restarts: int = 1, seed: int = 42, inputs=CLUSTER_INPUTS) -> list[lloyd.Fitted]:
    """The best model per k; all k and starts are fitted together."""
    models = [lloyd.Model(k, i) for k in ks for i in range(restarts)]
    rows = model_rows(points, models, inputs)
    fits = lloyd.fit_models(rows, models, len(inputs), seed)
    rows.unpersist()
    return [lloyd.best_of([f for f in fits if f.model.k == k]) for k in ks]


def sweep_k(points: DataFrame, ks=K_RANGE, restarts: int = 1, seed: int = 42, inputs=CLUSTER_INPUTS) -> DataFrame:
    """Quality of the best labelling per k."""
    points = for_iteration(points, work=LABELLING)
    frames = []
    for fit in sweep_models(points, ks, restarts, seed, inputs):
        row = metrics.cluster_quality(fit.assign(points, inputs), "segment", inputs).first()
        frames.append((fit.model.k, *[float(row[c]) for c in ("inertia", "silhouette", "davies_bouldin", "calinski_harabasz", "smallest_share")]))
    points.unpersist()
    return points.sparkSession.createDataFrame(
        frames, "k int, inertia double, silhouette double, davies_bouldin double, calinski_harabasz double, smallest_share double"
    ).withColumn("eligible", F.col("smallest_share") >= MIN_SHARE)


def second_opinion(points: DataFrame, labels: DataFrame, k: int, key: str, seed: int = 42,
                   inputs=CLUSTER_INPUTS) -> DataFrame:
    """Agreement with a divisive clustering, which optimises another objective."""
    # A split starts from the centre moved by a share of its norm, and the
    # centre of standardised data is zero: shift the points, distances stay.
    shifted = VectorAssembler(inputCols=[f"_s{i}" for i in range(len(inputs))], outputCol="shifted").transform(
        points.select(key, *[(F.col(c) + SHIFT).alias(f"_s{i}") for i, c in enumerate(inputs)])).select(key, "shifted")
    shifted = for_iteration(shifted)
    other = BisectingKMeans(k=k, seed=seed, featuresCol="shifted", predictionCol="other").fit(shifted).transform(shifted)
    return metrics.adjusted_rand(labels.join(other.select(key, "other"), key), "segment", "other")


def resample_agreement(points: DataFrame, own: lloyd.Fitted, key: str, runs: int = RESAMPLES,
                       restarts: int = RESAMPLE_RESTARTS, seed: int = 42, inputs=CLUSTER_INPUTS) -> DataFrame:
    """Agreement of refits on exact 80% samples with the full labelling.

    Samples are 0/1 weights of the rows; all runs and starts are fitted together.
    """
    hashes = [seeded_hash(key, f"{seed}:{r}") for r in range(runs)]
    cuts = hash_cuts(points, hashes, lambda n: [math.floor(RESAMPLE_SHARE * n)])
    models = [lloyd.Model(own.model.k, i, r) for r in range(runs) for i in range(restarts)]
    rows = model_rows(points, models, inputs, [cuts.below(h, i).cast("int") for i, h in enumerate(hashes)])
    fits = lloyd.fit_models(rows, models, len(inputs), seed)
    best = [lloyd.best_of([f for f in fits if f.model.sample == r]) for r in range(runs)]
    found = lloyd.agreement(rows, own, best)
    rows.unpersist()
    return points.sparkSession.createDataFrame([(r, float(v)) for r, v in enumerate(found)], "run int, ari double")


def stability(cross: DataFrame, resamples: DataFrame) -> DataFrame:
    """One row: both agreement means and whether the structure holds."""
    summary = resamples.agg(F.avg("ari").alias("bootstrap_ari_mean"), F.stddev_pop("ari").alias("bootstrap_ari_std"),
                            F.count("*").alias("bootstrap_iterations"))
    return cross.withColumnRenamed("adjusted_rand_index", "cross_method_ari").join(summary).withColumn(
        "stable", (F.col("cross_method_ari") >= STABLE_ARI) & (F.col("bootstrap_ari_mean") >= STABLE_ARI))


def project(points: DataFrame, keep=()) -> DataFrame:
    """Two principal components (inputs are centred already) and explained share."""
    model = PCA(k=2, inputCol="features", outputCol="_p").fit(points)
    share = [float(v) for v in model.explainedVariance]
    xy = vector_to_array("_p")
    return model.transform(points).select(*keep, xy[0].alias("component_1"), xy[1].alias("component_2"),
                                          F.lit(share[0]).alias("explained_1"), F.lit(share[1]).alias("explained_2"))
