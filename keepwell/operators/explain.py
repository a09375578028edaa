"""Explanations of a stored model, read from its own fitted stages.

A linear pipeline is walked stage by stage and every column of its feature vector
turns into a term: an expression over the input columns, shifted and scaled by the
stages behind it. Shifts and scales fold into the coefficient, so contributions
are weights on raw values. A boosted pipeline keeps its trees; its base value is
the mean of every tree over its training rows. In both cases base plus
contributions is the margin of the stored model.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.ml.feature import (
    ElementwiseProduct, OneHotEncoderModel, StandardScalerModel, StringIndexerModel, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from keepwell.operators import contributions as contrib
from keepwell.schema import ID
from keepwell.session import scratch_folder

MARGIN = "margin"


@dataclass
class Term:
    """(value - shift) x scale, as the model sees it."""

    name: str
    value: Column
    shift: float = 0.0
    scale: float = 1.0


@dataclass
class Linear:
    """Raw-scale form of a linear pipeline."""

    terms: dict[str, Column]
    weights: dict[str, float]
    intercept: float


def resolve_linear(pipeline: PipelineModel) -> Linear:
    """Terms, weights and intercept of a fitted linear pipeline; another stage raises ValueError."""
    vectors: dict[str, list[Term]] = {}
    indexed: dict[str, tuple[str, list[str]]] = {}

    def terms_of(column: str) -> list[Term]:
        return vectors[column] if column in vectors else [Term(column, F.col(column).cast("double"))]

    for stage in pipeline.stages:
        if isinstance(stage, StringIndexerModel):
            indexed.update({out: (source, list(labels)) for source, out, labels in zip(stage.getInputCols(), stage.getOutputCols(), stage.labelsArray)})
        elif isinstance(stage, OneHotEncoderModel):
            for source, out, size in zip(stage.getInputCols(), stage.getOutputCols(), stage.categorySizes):
                column, labels = indexed[source]
                slots = labels[:size - 1 if stage.getDropLast() else size]
                vectors[out] = [Term(f"{column}_{v}", F.coalesce((F.col(column) == v).cast("double"), F.lit(0.0))) for v in slots]
        elif isinstance(stage, VectorAssembler):
            vectors[stage.getOutputCol()] = [t for c in stage.getInputCols() for t in terms_of(c)]
        elif isinstance(stage, StandardScalerModel):
            own = terms_of(stage.getInputCol())
            mean = stage.mean.toArray() if stage.getWithMean() else np.zeros(len(own))
            sd = stage.std.toArray() if stage.getWithStd() else np.ones(len(own))
            # (shifted value x scale) - m over s, written as one shift and one scale
            vectors[stage.getOutputCol()] = [
                Term(t.name, t.value, t.shift + float(m) / t.scale, t.scale / float(s) if s else 0.0) for t, m, s in zip(own, mean, sd)]
        elif isinstance(stage, ElementwiseProduct):
            vectors[stage.getOutputCol()] = [Term(t.name, t.value, t.shift, t.scale * float(w)) for t, w in zip(terms_of(stage.getInputCol()), stage.getScalingVec().toArray())]
        elif isinstance(stage, LogisticRegressionModel):
            own, beta = terms_of(stage.getFeaturesCol()), stage.coefficients.toArray()
            if len(own) != len(beta):
                raise ValueError("the stages don't give as many terms as the model has")
            weights = {t.name: float(b) * t.scale for t, b in zip(own, beta)}
            shift = sum(float(b) * t.scale * t.shift for t, b in zip(own, beta))
            return Linear({t.name: t.value for t in own}, weights, float(stage.intercept) - shift)
        else:
            raise ValueError(f"no terms for a stage of kind {type(stage).__name__}")
    raise ValueError("the pipeline has no model")


def tree_base(nodes: DataFrame, weights) -> float:
    """Mean margin over the rows that trained the trees."""
    total = 0.0
    for tree, w in zip(contrib._load_trees(nodes), weights):
        def mean(node):
            left, right = tree["left"][node], tree["right"][node]
            if left < 0:
                return tree["value"][node]
            a, b = tree["cover"][left], tree["cover"][right]
            return (a * mean(left) + b * mean(right)) / (a + b)
        total += w * mean(0)
    return total


def explain(scorer, rows: DataFrame, means: dict[str, float] | None = None, key: str = ID) -> DataFrame:
    """(key, contributions, base_value) of a stored model's margin for every row.

    ``means`` is the background of a linear model, the rows themselves without it.
    """
    prepared = scorer.shape.prepare(rows)
    model = scorer.pipeline.stages[-1]
    if isinstance(model, GBTClassificationModel):
        path = scratch_folder(rows.sparkSession, "explained-trees")
        model.write().overwrite().save(path)
        nodes, columns = contrib.tree_nodes(rows.sparkSession, path), scorer.shape.code_columns
        out = contrib.tree_contributions(prepared, nodes, model.treeWeights, [c.removesuffix("_code") for c in columns], columns, key)
        return out.withColumn("base_value", F.lit(tree_base(nodes, model.treeWeights)))
    linear = resolve_linear(scorer.pipeline)
    means = contrib.background_means(prepared, linear.terms) if means is None else means
    base = linear.intercept + sum(w * means[n] for n, w in linear.weights.items())
    return contrib.linear_contributions(prepared, linear.terms, linear.weights, means).select(key, "contributions", F.lit(base).alias("base_value"))


def margins(scorer, rows: DataFrame, key: str = ID) -> DataFrame:
    """(key, margin) as the stored model itself computes it."""
    raw = vector_to_array("rawPrediction")[1]
    return scorer.pipeline.transform(scorer.shape.prepare(rows)).select(key, raw.alias(MARGIN))


def additivity(explained: DataFrame, margin: DataFrame, key: str = ID) -> DataFrame:
    """(key, terms, gap): how far base plus contributions is from the margin."""
    total = F.aggregate("contributions", F.lit(0.0), lambda s, e: s + e["shap_value"])
    return explained.join(margin, key).select(key, F.size("contributions").alias("terms"), (F.col("base_value") + total - F.col(MARGIN)).alias("gap"))
