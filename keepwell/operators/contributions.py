"""Per-customer contributions of model inputs and what is built from them.

A customer's contributions stay one array in that customer's row. Ranking,
top drivers and the long form all come from sorting that array, so nothing is
shuffled and the long table only exists where it is asked for.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from keepwell.functions.scoring import direction, strip_prefix
from keepwell.schema import ID


def background_means(df: DataFrame, terms: Mapping[str, Column]) -> dict[str, float]:
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(terms.values())]).first()
    return {n: float(row[f"m{i}"] or 0.0) for i, n in enumerate(terms)}


def linear_contributions(df: DataFrame, terms: Mapping[str, Column], weights: Mapping[str, float],
                         means: Mapping[str, float] | None = None) -> DataFrame:
    """Adds ``contributions``: weight x (value - background mean) per term.

    A weight on the raw scale times the raw gap equals the scaled weight times
    the scaled gap, so no scaler is needed here.
    """
    if means is None:
        means = background_means(df, terms)
    entries = []
    for i, (name, value) in enumerate(terms.items()):
        v = value.cast("double")
        shap = F.lit(float(weights.get(name, 0.0))) * (v - F.lit(means[name]))
        entries.append(F.struct(F.lit(i).alias("position"), strip_prefix(F.lit(name)).alias("feature"),
                                shap.alias("shap_value"), v.alias("feature_value")))
    return df.withColumn("contributions", F.array(*entries))


def ranked(column: str = "contributions") -> Column:
    """The array by descending size; equal sizes keep their original order."""
    size = lambda e: F.abs(e["shap_value"])
    return F.array_sort(column, lambda a, b: F.when(size(a) > size(b), -1).when(size(a) < size(b), 1)
                        .otherwise(a["position"] - b["position"]))


def first_customers(df: DataFrame, limit: int, key: str = ID) -> DataFrame:
    """Optional cap for a dashboard extract: the first customers by id."""
    return df.orderBy(key).limit(limit)


def long_contributions(df: DataFrame, key: str = ID) -> DataFrame:
    """One row per customer and feature with its rank for that customer."""
    rows = df.select(key, F.posexplode(ranked()).alias("rank0", "e"))
    value = F.col("e.shap_value")
    return rows.select(
        key, F.col("e.feature").alias("feature"), value.alias("shap_value"),
        F.col("e.feature_value").alias("feature_value"), F.abs(value).alias("abs_shap"),
        direction(value).alias("direction"), (F.col("rank0") + 1).cast("int").alias("rank_within_customer"))


def global_importance(df: DataFrame) -> DataFrame:
    """Mean absolute and signed contribution per feature, ranked.

    The result has one row per feature, so its global order is tiny.
    """
    from pyspark.sql import Window
    per = (df.select(F.explode("contributions").alias("e"))
           .groupBy(F.col("e.feature").alias("feature"))
           .agg(F.avg(F.abs("e.shap_value")).alias("mean_abs_shap"),
                F.avg("e.shap_value").alias("mean_signed_shap")))
    return per.withColumns({
        "direction": direction(F.col("mean_signed_shap")),
        "rank": F.row_number().over(Window.orderBy(F.desc("mean_abs_shap"), "feature"))})


def with_top_drivers(df: DataFrame, top: int = 3) -> DataFrame:
    """Widen the strongest contributions into driver columns.

    A frame without contributions is returned unchanged.
    """
    if "contributions" not in df.columns:
        return df
    out = df.withColumn("_r", ranked())
    columns = {}
    for k in range(1, top + 1):
        e = F.try_element_at("_r", F.lit(k))
        columns[f"driver_{k}_feature"] = e["feature"]
        columns[f"driver_{k}_shap"] = e["shap_value"]
        columns[f"driver_{k}_direction"] = F.when(e["shap_value"].isNotNull(), direction(e["shap_value"]))
    return out.withColumns(columns).drop("_r", "contributions")


def drivers_from_long(long: DataFrame, customers: DataFrame, top: int = 3, key: str = ID) -> DataFrame:
    """The same widening when only the long table is at hand: pivot, one join."""
    kept = long.filter(F.col("rank_within_customer") <= top)
    wide = kept.groupBy(key).pivot("rank_within_customer", list(range(1, top + 1))).agg(
        F.first("feature").alias("feature"), F.first("shap_value").alias("shap"),
        F.first("direction").alias("direction"))
    named = wide.select(key, *[F.col(f"{k}_{p}").alias(f"driver_{k}_{p}")
                               for k in range(1, top + 1) for p in ("feature", "shap", "direction")])
    return customers.join(named, key, "left")


# --- tree ensembles ----------------------------------------------------------

def tree_nodes(spark, model_path: str) -> DataFrame:
    """Node table of a saved boosted or forest model."""
    return spark.read.parquet(f"{model_path}/data").select("treeID", "nodeData.*")


def _load_trees(nodes: DataFrame) -> list[dict]:
    """Model nodes as arrays per tree (size set by the model, not the data)."""
    pdf = nodes.select("treeID", "id", "prediction", "leftChild", "rightChild", "split", "impurityStats",
                       "rawCount").toPandas()
    trees = []
    for _, part in pdf.groupby("treeID"):
        part = part.sort_values("id")
        split = [r["split"] if hasattr(r, "keys") or isinstance(r, dict) else r for r in part.to_dict("records")]
        trees.append({
            "left": part["leftChild"].tolist(), "right": part["rightChild"].tolist(),
            "value": part["prediction"].tolist(), "cover": part["rawCount"].astype(float).tolist(),
            "feature": [int(s["featureIndex"]) for s in split],
            "cut": [np.asarray(s["leftCategoriesOrThreshold"], dtype=float) for s in split],
            "arity": [int(s["numCategories"]) for s in split]})
    return trees


def _follows_left(tree, node, x):
    """Which rows of a batch take the left branch."""
    v, cut = x[:, tree["feature"][node]], tree["cut"][node]
    return v <= cut[0] if tree["arity"][node] < 0 else np.isin(v, cut)


def _tree_values(tree, x, phi, scale):
    """Path-dependent Shapley values of one tree for a batch of rows.

    A leaf is a product game over the features on its path: a feature inside
    the coalition contributes whether the row follows the path, one outside
    contributes the share of training rows that do. The Shapley value of a
    product follows from the elementary symmetric sums of the other factors.
    """
    def walk(node, path):
        left = tree["left"][node]
        if left < 0:
            leaf(tree["value"][node] * scale, path)
            return
        right, f = tree["right"][node], tree["feature"][node]
        goes = _follows_left(tree, node, x)
        total = tree["cover"][left] + tree["cover"][right]
        for child, follows in ((left, goes), (right, ~goes)):
            one, zero = path.get(f, (np.ones(len(x)), 1.0))
            walk(child, {**path, f: (one * follows, zero * tree["cover"][child] / total)})

    def leaf(value, path):
        m = len(path)
        for f, (one, zero) in path.items():
            by_size = [np.ones(len(x))]
            for g, (o, z) in path.items():
                if g != f:
                    inside = [np.zeros(len(x)), *[c * o for c in by_size]]
                    outside = [*[c * z for c in by_size], np.zeros(len(x))]
                    by_size = [a + b for a, b in zip(inside, outside)]
            weight, total = 1.0 / m, 0.0
            for size, c in enumerate(by_size):
                total = total + weight * c
                weight *= (size + 1) / max(m - size - 1, 1)
            phi[:, f] += value * (one - zero) * total

    walk(0, {})


def tree_contributions(df: DataFrame, nodes: DataFrame, tree_weights, features: list[str],
                       vector_columns: list[str], key: str = ID) -> DataFrame:
    """Contributions of a boosted model's raw margin per customer.

    The node table is broadcast (its size is the model's, not the data's);
    rows are processed where they are.
    """
    trees = df.sparkSession.sparkContext.broadcast((_load_trees(nodes), list(tree_weights)))
    entry = "array<struct<position:int,feature:string,shap_value:double,feature_value:double>>"

    def explain(batches):
        ensemble, weights = trees.value
        for pdf in batches:
            x = pdf[vector_columns].to_numpy(dtype=float)
            phi = np.zeros((len(x), len(features)))
            for tree, w in zip(ensemble, weights):
                _tree_values(tree, x, phi, w)
            yield pd.DataFrame({key: pdf[key], "contributions": [
                [{"position": i, "feature": f, "shap_value": float(p[i]), "feature_value": float(v[i])}
                 for i, f in enumerate(features)] for p, v in zip(phi, x)]})

    return df.select(key, *vector_columns).mapInPandas(explain, f"{key} string, contributions {entry}")
