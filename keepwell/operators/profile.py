"""Baselines and drift between a training frame and a scoring frame."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from keepwell.operators.quantiles import exact_quantiles
from keepwell.schema import active_groups, drop_non_features

# --- fixed values: drift thresholds ----------------------------------------
MEAN_DRIFT_PERCENT = 10.0
STD_DRIFT_PERCENT = 10.0
TVD_LIMIT = 0.1
SMALLEST_DENOMINATOR = 1e-8
# --- end of fixed values ----------------------------------------------------


def number(c):
    """Double with NaN read as NULL, so averages skip it."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def numeric_baseline(df: DataFrame, columns=None) -> DataFrame:
    """(feature, mean, std, min, max) from one aggregate over the frame."""
    columns = columns or active_groups(df.columns)[2]
    wide = df.agg(*[
        F.struct(F.avg(number(c)).alias("mean"), F.stddev_samp(number(c)).alias("std"),
                 F.min(number(c)).alias("min"), F.max(number(c)).alias("max")).alias(c)
        for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("s")) for c in columns])
    return wide.select(F.explode(rows).alias("r")).select("r.feature", "r.s.*")


def baseline_stats(df: DataFrame, columns=None) -> DataFrame:
    """The same baseline in long form: (feature, stat, value)."""
    return numeric_baseline(df, columns).unpivot(
        "feature", ["mean", "std", "min", "max"], "stat", "value")


def level_counts(df: DataFrame, columns, extra=()) -> DataFrame:
    """(feature, category, n, ...) in one pass; NULL levels are left out."""
    kept = [c for c in columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"),
                               F.col(c).cast("string").alias("category")) for c in kept])
    long = df.select(*[e for e, _ in extra], F.explode(pairs).alias("p"))
    return (long.filter("p.category is not null")
            .groupBy("p.feature", "p.category")
            .agg(F.count("*").alias("n"), *[a for _, a in extra]))


def categorical_baseline(df: DataFrame, columns=None) -> DataFrame:
    """(feature, category, n, share) with shares over the non-NULL rows."""
    if columns is None:
        nominal, ordinal, _ = active_groups(df.columns)
        columns = nominal + ordinal
    counts = level_counts(df, columns)
    return counts.withColumn(
        "share", F.col("n") / F.sum("n").over(Window.partitionBy("feature")))


def numeric_drift(baseline: DataFrame, scoring: DataFrame) -> DataFrame:
    """Percent shift of mean and deviation; flags use the unrounded shift.

    Both sides are one row per feature, so the join is tiny.
    """
    b = baseline.select("feature", F.col("mean").alias("train_mean"), F.col("std").alias("train_std"))
    s = scoring.select("feature", F.col("mean").alias("scoring_mean"), F.col("std").alias("scoring_std"))

    def shift(now, then):
        size = F.greatest(F.abs(F.col(then)), F.lit(SMALLEST_DENOMINATOR))
        return F.abs(F.col(now) - F.col(then)) / size * 100

    out = b.join(s, "feature").withColumns({
        "mean_drift_percent": shift("scoring_mean", "train_mean"),
        "std_drift_percent": shift("scoring_std", "train_std")})
    return out.withColumn("drifted", F.coalesce(
        (F.col("mean_drift_percent") > MEAN_DRIFT_PERCENT)
        | (F.col("std_drift_percent") > STD_DRIFT_PERCENT), F.lit(False)))


def aligned_shares(baseline: DataFrame, scoring: DataFrame, scoring_columns: Sequence[str] = ()) -> DataFrame:
    """Full alignment of two category distributions; an absent level has share 0.

    Features known to one side only are left out; that test reads the joined
    levels again instead of joining once more. ``scoring_columns`` are columns
    the scoring side has: one of them without any value keeps its feature, whose
    levels then have all vanished.
    """
    b = baseline.select("feature", "category", F.col("share").alias("train_share"))
    s = scoring.select("feature", "category", F.col("share").alias("scoring_share"))
    known = Window.partitionBy("feature")              # the levels of one feature
    joined = b.join(s, ["feature", "category"], "full").fillna(0.0, ["train_share", "scoring_share"])
    return (joined.withColumn("_both", (F.max("train_share").over(known) > 0) & ((F.max("scoring_share").over(known) > 0) | F.col("feature").isin(list(scoring_columns))))
            .filter("_both").drop("_both"))


def categorical_drift(baseline: DataFrame, scoring: DataFrame, scoring_columns: Sequence[str] = ()) -> DataFrame:
    """Total variation distance with new and vanished categories per feature."""
    sides = aligned_shares(baseline, scoring, scoring_columns)
    names = lambda test: F.array_sort(F.collect_set(F.when(test, F.col("category"))))
    return (
        sides.groupBy("feature").agg(
            (0.5 * F.sum(F.abs(F.col("train_share") - F.col("scoring_share")))).alias("tvd"),
            names(F.col("train_share") == 0).alias("new_categories"),
            names(F.col("scoring_share") == 0).alias("missing_categories"))
        .withColumn("drifted", F.col("tvd") > TVD_LIMIT)
    )


def drift_summary(numeric: DataFrame, categorical: DataFrame,
                  trained_columns, scoring_columns) -> DataFrame:
    """One row: how many features drifted, which columns are missing or extra."""
    flags = (numeric.select(F.lit("numeric").alias("kind"), "drifted")
             .unionByName(categorical.select(F.lit("categorical").alias("kind"), "drifted")))
    missing = sorted(set(trained_columns) - set(scoring_columns))
    extra = sorted(set(scoring_columns) - set(trained_columns))
    per = lambda kind, drifted: F.count_if(
        (F.col("kind") == kind) & (F.col("drifted") if drifted else F.lit(True)))
    texts = lambda names: F.array(*[F.lit(n) for n in names]).cast("array<string>")
    return flags.agg(
        per("numeric", False).alias("numeric_features"),
        per("numeric", True).alias("numeric_drifted"),
        per("categorical", False).alias("categorical_features"),
        per("categorical", True).alias("categorical_drifted"),
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("drift_detected"),
    ).withColumns({"missing_features": texts(missing), "extra_features": texts(extra)})


def drift_report(train: DataFrame, scoring: DataFrame) -> dict[str, DataFrame]:
    """All drift tables for two frames of model inputs."""
    train_x, scoring_x = drop_non_features(train), drop_non_features(scoring)
    numeric = numeric_drift(numeric_baseline(train_x), numeric_baseline(scoring_x))
    categorical = categorical_drift(categorical_baseline(train_x), categorical_baseline(scoring_x), scoring_x.columns)
    return {"numeric": numeric, "categorical": categorical,
            "summary": drift_summary(numeric, categorical, train_x.columns, scoring_x.columns)}


def flagged_features(numeric: DataFrame, categorical: DataFrame) -> DataFrame:
    """Names of drifted features with the check that caught them."""
    return (numeric.filter("drifted").select("feature", F.lit("numeric").alias("kind"))
            .unionByName(categorical.filter("drifted").select("feature", F.lit("categorical").alias("kind"))))


def missing_counts(df: DataFrame) -> DataFrame:
    """(column_name, nulls, blanks) from one aggregate."""
    text = {f.name for f in df.schema if f.dataType.typeName() == "string"}
    one = df.agg(*[
        F.struct(F.count_if(F.col(c).isNull()).alias("nulls"),
                 (F.count_if(F.trim(F.col(c)) == "") if c in text else F.lit(0)).cast("long").alias("blanks")
                 ).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("s")) for c in df.columns])
    return one.select(F.explode(rows).alias("r")).select("r.column_name", "r.s.*")


def describe(df: DataFrame, columns) -> DataFrame:
    """Count, mean, deviation, range and exact quartiles per numeric column."""
    quartiles = exact_quantiles(df, {c: number(c) for c in columns}, [Fraction(i, 4) for i in (1, 2, 3)])
    rows = [(c, *(quartiles[c] or [None] * 3)) for c in columns]
    spark = df.sparkSession
    counts = df.agg(*[F.count(number(c)).alias(c) for c in columns]).unpivot([], list(columns), "feature", "n")
    return (counts.join(numeric_baseline(df, columns), "feature")
            .join(spark.createDataFrame(rows, "feature string, q25 double, q50 double, q75 double"), "feature"))


def class_balance(df: DataFrame, target: str) -> DataFrame:
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    everything = Window.partitionBy()          # one row per class
    return counts.withColumns({
        "percent": 100 * F.col("n") / F.sum("n").over(everything),
        "imbalance_ratio": F.max("n").over(everything) / F.min("n").over(everything)})


def rate_by_level(df: DataFrame, columns, target: str) -> DataFrame:
    """Target rate for every level of every column in a single shuffle."""
    counts = level_counts(df, columns, [(F.col(target), F.sum(target).alias("positives"))])
    return counts.withColumn("rate", F.col("positives") / F.col("n"))


def class_histogram(df: DataFrame, columns, target: str, bins: int = 30) -> DataFrame:
    """Density histogram per column and class over that class's own range.

    The ranges are one row per class and column and travel as a broadcast.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), number(c).alias("v")) for c in columns])
    long = (df.select(F.col(target).alias("class"), F.explode(pairs).alias("p"))
            .select("class", "p.feature", "p.v").filter("v is not null"))
    spans = long.groupBy("feature", "class").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("total"))
    slot = F.least(F.floor((F.col("v") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))),
                   F.lit(bins - 1))
    return (
        long.join(F.broadcast(spans), ["feature", "class"])
        .withColumn("bin", F.when(F.col("hi") > F.col("lo"), slot).otherwise(0).cast("int"))
        .groupBy("feature", "class", "bin", "lo", "hi", "total").agg(F.count("*").alias("n"))
        .withColumn("density", F.try_divide(
            F.col("n") * F.lit(float(bins)), F.col("total") * (F.col("hi") - F.col("lo"))))
    )


def correlation_pairs(df: DataFrame, columns) -> DataFrame:
    """Pearson correlation of every ordered pair, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = df.agg(*[F.corr(number(a), number(b)).alias(f"{a}|{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        value = F.col(f"`{a}|{b}`")
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("feature_a"), F.lit(y).alias("feature_b"),
                                  value.alias("r")))
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def point_biserial(df: DataFrame, columns, target: str) -> DataFrame:
    """Correlation of a 0/1 target with each column, its t and degrees of freedom."""
    y = number(target)
    both = lambda c: y.isNotNull() & number(c).isNotNull()
    one = df.agg(*[F.struct(F.corr(number(c), y).alias("r"),
                            F.count_if(both(c)).alias("n")).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("s")) for c in columns])
    return (one.select(F.explode(rows).alias("x")).select("x.feature", "x.s.*")
            .withColumn("dof", F.col("n") - 2)
            .withColumn("t", F.col("r") * F.sqrt(F.try_divide("dof", 1 - F.col("r") * F.col("r")))))


def stars(p) :
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")


def union_all(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
