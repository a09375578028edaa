"""Candidate models, parameter search, scoring and persistence."""

from __future__ import annotations

import json
import math
import random
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from keepwell.functions.features import ensure_engineered
from keepwell.functions.scoring import hard_prediction
from keepwell.operators import metrics
from keepwell.operators.encode import (
    balanced_weight, category_code, contract_code, linear_stages, pinned_levels,
)
from keepwell.schema import TARGET, active_groups, align
from keepwell.session import for_iteration

LINEAR, TREE_CODES = "linear", "tree_codes"


@dataclass
class Shape:
    """Everything needed to turn raw rows into one model's input."""

    kind: str
    feature_names: list[str]
    nominal: list[str]
    ordinal: list[str]
    numeric: list[str]
    levels: dict[str, list[str]]

    def prepare(self, df: DataFrame) -> DataFrame:
        """Engineered columns if absent, trained columns required, codes added."""
        full = ensure_engineered(df, self.feature_names)
        align(full, self.feature_names)
        if self.kind == LINEAR:
            return full.withColumns({f"{c}_code": contract_code(c).cast("double") for c in self.ordinal})
        if self.kind == TREE_CODES:
            codes = {f"{c}_code": category_code(c, self.levels[c]).cast("double") for c in self.nominal}
            return full.withColumns({**codes, **{f"{c}_code": contract_code(c).cast("double") for c in self.ordinal}})
        raise ValueError(f"unknown model type: {self.kind!r}")

    @property
    def code_columns(self) -> list[str]:
        return [f"{c}_code" for c in self.nominal + self.ordinal] + self.numeric


def shape_of(df: DataFrame, kind: str, levels: dict | None = None) -> Shape:
    nominal, ordinal, numeric = active_groups(df.columns)
    names = [c for c in df.columns if c in {*nominal, *ordinal, *numeric}]
    return Shape(kind, names, nominal, ordinal, numeric, levels or pinned_levels(df, nominal))


@dataclass
class Scorer:
    """A fitted pipeline with its input shape."""

    name: str
    shape: Shape
    pipeline: PipelineModel
    version: str = ""

    def score(self, df: DataFrame) -> DataFrame:
        """Input columns plus ``churn_probability`` and ``prediction``."""
        keep = df.columns
        out = self.pipeline.transform(self.shape.prepare(df))
        p = vector_to_array("probability")[1]
        return out.select(*keep, p.alias("churn_probability"), hard_prediction(p).alias("prediction"))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/model")
        meta = {"name": self.name, "version": self.version, **self.shape.__dict__}
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark, path: str) -> "Scorer":
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        name, version = meta.pop("name"), meta.pop("version")
        return cls(name, Shape(**meta), PipelineModel.load(f"{path}/model"), version)


def fit_linear(train: DataFrame) -> Scorer:
    """Class-balanced L2 logistic regression on standardised one-hot inputs."""
    shape = shape_of(train, LINEAR)
    rows = shape.prepare(train).withColumn("_w", balanced_weight(train, TARGET))
    total = rows.agg(F.sum("_w")).first()[0]
    scaler = StandardScaler(inputCol="raw_features", outputCol="sample_scaled", withMean=True, withStd=True)
    model = LogisticRegression(labelCol=TARGET, weightCol="_w", regParam=1.0 / total, elasticNetParam=0.0,
                               standardization=False, maxIter=200)
    stages = [*linear_stages(shape.nominal, shape.ordinal, shape.numeric, "raw_features"), scaler]
    prepared = Pipeline(stages=stages).fit(rows)
    # the scaler divides by the sample deviation; the penalty is meant for population units
    n = rows.count()
    width = prepared.stages[-1].mean.size
    unit = ElementwiseProduct(scalingVec=Vectors.dense([math.sqrt(n / max(n - 1, 1))] * width), inputCol="sample_scaled", outputCol="features")
    prepared = PipelineModel([*prepared.stages, unit])
    fitted = model.fit(for_iteration(prepared.transform(rows).select("features", TARGET, "_w")))
    return Scorer("logistic_regression", shape, PipelineModel([*prepared.stages, fitted]))


# --- fixed values: learner defaults ------------------------------------------
LEARNING_RATE = 0.05
FIRST_TREES = {"maxDepth": 5, "maxIter": 500}
SECOND_TREES = {"maxDepth": 6, "maxIter": 500}
SEARCH_TRIALS = 50
# --- end of fixed values ----------------------------------------------------


def tree_matrix(train: DataFrame, validation: DataFrame, levels: dict | None = None) -> tuple:
    """(shape, assembler, cached rows) that all boosted-tree fits on these rows share."""
    shape = shape_of(train, TREE_CODES, levels)
    pos = train.agg(F.count_if(F.col(TARGET) == 0).alias("n"), F.count_if(F.col(TARGET) == 1).alias("p")).first()
    weight = F.when(F.col(TARGET) == 1, pos["n"] / max(pos["p"], 1)).otherwise(1.0)
    rows = (shape.prepare(train).withColumn("_v", F.lit(False))
            .unionByName(shape.prepare(validation).withColumn("_v", F.lit(True)))
            .withColumn("_w", weight))
    gather = VectorAssembler(inputCols=shape.code_columns, outputCol="features", handleInvalid="keep")
    return shape, gather, for_iteration(gather.transform(rows).select("features", TARGET, "_w", "_v"))


def fit_trees(train: DataFrame, validation: DataFrame, name: str, levels: dict | None = None, matrix: tuple | None = None, **params) -> Scorer:
    """Boosted trees on integer codes; positives carry the class weight.

    Rounds stop when the validation error no longer improves.
    """
    shape, gather, rows = matrix or tree_matrix(train, validation, levels)
    options = {"stepSize": LEARNING_RATE, "seed": 42, "maxBins": 64, "validationTol": 1e-4, **params}
    model = GBTClassifier(labelCol=TARGET, featuresCol="features", weightCol="_w", validationIndicatorCol="_v", **options)
    fitted = model.fit(rows)
    return Scorer(name, shape, PipelineModel([gather, fitted]))


def evaluate(scorer: Scorer, df: DataFrame) -> DataFrame:
    """One row: exact AUC with precision, recall, F1 and support at 0.5."""
    scored = scorer.score(df)
    return (metrics.classification(scored, TARGET, "prediction")
            .join(metrics.roc_auc(scored, TARGET, "churn_probability"))      # single rows
            .select(F.lit(scorer.name).alias("model"), "roc_auc", "precision", "recall", "f1_score", "support"))


def candidate_metrics(scorers, test: DataFrame) -> DataFrame:
    frames = [evaluate(s, test) for s in scorers]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def winner(comparison: DataFrame) -> DataFrame:
    """Best candidate by AUC flagged as deployed, best first."""
    best = comparison.agg(F.max_by("model", F.struct("roc_auc", "model")).alias("best"))      # ties by name
    return (comparison.join(F.broadcast(best)).withColumn("deployed", F.col("model") == F.col("best"))
            .drop("best").orderBy(F.desc("roc_auc"), F.desc("model")))


def search_space(trials: int = SEARCH_TRIALS, seed: int = 42) -> list[dict]:
    """Seeded random draws of boosting parameters."""
    rng = random.Random(seed)
    log = lambda lo, hi: lo * (hi / lo) ** rng.random()
    return [{"maxIter": rng.randint(100, 1000), "stepSize": log(0.01, 0.3), "maxDepth": rng.randint(3, 7),
             "minInstancesPerNode": rng.randint(5, 100), "subsamplingRate": 0.5 + 0.5 * rng.random(),
             "featureSubsetStrategy": f"{0.5 + 0.5 * rng.random():.3f}"} for _ in range(trials)]


def search_trees(train: DataFrame, validation: DataFrame, space: list[dict], matrix: tuple | None = None) -> tuple[DataFrame, dict]:
    """Fit every draw; one row per trial with its validation AUC, and the best draw."""
    matrix = matrix or tree_matrix(train, validation, pinned_levels(train, active_groups(train.columns)[0]))
    rows = []
    for i, params in enumerate(space):
        scorer = fit_trees(train, validation, f"trial_{i}", matrix=matrix, **params)
        auc = metrics.roc_auc(scorer.score(validation), TARGET, "churn_probability").first()["roc_auc"]
        rows.append((i, json.dumps(params), float(auc)))
    best = max(rows, key=lambda r: (r[2], -r[0]))
    return train.sparkSession.createDataFrame(rows, "trial int, params string, roc_auc double"), space[best[0]]
