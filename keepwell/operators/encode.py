"""Encoders, scaling and exact seeded splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from keepwell.operators.ranking import SharedHash, hash_cuts, hash_rank, seeded_hash
from keepwell.schema import CONTRACT_LEVELS, TARGET


def category_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, levels): sorted distinct non-NULL levels, in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level"))
                      for c in columns])
    return (df.select(F.explode(pairs).alias("p")).select("p.*").filter("level is not null")
            .groupBy("feature").agg(F.array_sort(F.collect_set("level")).alias("levels")))


def pinned_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Levels as plain lists; bounded by the schema's category domains."""
    found = {r["feature"]: list(r["levels"]) for r in category_levels(df, columns).collect()}
    return {c: found.get(c, []) for c in columns}


def category_code(column: str, levels: Sequence[str]) -> Column:
    """Position among the pinned levels; unseen or NULL is -1."""
    code = None
    for i, level in enumerate(levels):
        test = F.col(column) == level
        code = F.when(test, i) if code is None else code.when(test, i)
    return F.lit(-1) if code is None else code.otherwise(-1).cast("int")


def contract_code(column: str = "Contract") -> Column:
    return category_code(column, CONTRACT_LEVELS)


def with_codes(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    return df.withColumns({c: category_code(c, v) for c, v in levels.items()})


def indicator(column: str, level: str) -> Column:
    return F.coalesce((F.col(column) == level).cast("double"), F.lit(0.0))


def one_hot_terms(levels: Mapping[str, Sequence[str]], drop_first: bool = False) -> dict[str, Column]:
    """One 0/1 column per level; with ``drop_first`` the first is the referent."""
    return {f"{c}_{v}": indicator(c, v)
            for c, vs in levels.items() for v in (vs[1:] if drop_first else vs)}


def reference_design(df: DataFrame, nominal, ordinal, numeric,
                     levels: Mapping[str, Sequence[str]] | None = None) -> dict[str, Column]:
    """Reference-coded design: first level per categorical dropped."""
    levels = levels or pinned_levels(df, [*nominal, *ordinal])
    terms = one_hot_terms({c: levels[c] for c in [*nominal, *ordinal]}, drop_first=True)
    return {**terms, **{c: F.col(c).cast("double") for c in numeric}}


def scaling(df: DataFrame, terms: Mapping[str, Column]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per term; a constant term has deviation 1."""
    row = df.agg(*[e for i, c in enumerate(terms.values()) for e in (
        F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}"))]).first()
    return {n: (float(row[f"m{i}"] or 0.0), float(row[f"s{i}"] or 0.0) or 1.0)
            for i, n in enumerate(terms)}


def scaled(terms: Mapping[str, Column], scale: Mapping[str, tuple[float, float]]) -> dict[str, Column]:
    return {n: (c.cast("double") - F.lit(scale[n][0])) / F.lit(scale[n][1]) for n, c in terms.items()}


def linear_stages(nominal: Sequence[str], ordinal: Sequence[str], numeric: Sequence[str],
                  output: str = "features") -> list:
    """ML stages for the linear shape.

    ``keep`` reserves a last index for unseen and NULL levels and ``dropLast``
    removes exactly that slot, so an unknown level encodes as all zeros. The
    ordinal column is coded by :func:`contract_code` beforehand.
    """
    index = StringIndexer(inputCols=list(nominal), outputCols=[f"{c}_ix" for c in nominal],
                          stringOrderType="alphabetAsc", handleInvalid="keep")
    hot = OneHotEncoder(inputCols=[f"{c}_ix" for c in nominal],
                        outputCols=[f"{c}_hot" for c in nominal], dropLast=True)
    gather = VectorAssembler(inputCols=[*[f"{c}_hot" for c in nominal], *[f"{c}_code" for c in ordinal], *numeric],
                             outputCol=output)
    return [index, hot, gather]


def stratified_split(df: DataFrame, key: str, seed, target: str = TARGET,
                     test: Fraction = Fraction(1, 5), validation: Fraction = Fraction(1, 5)) -> DataFrame:
    """Adds ``split``: train / validation / test with exact counts per class.

    Rows are flagged where they lie; only if keys repeat at a cut are they ranked.
    """
    cut = lambda n, f: (2 * n * f.numerator + f.denominator) // (2 * f.denominator)
    ends = lambda n: (cut(n, test), cut(n, test) + cut(n, validation))
    try:
        cuts = hash_cuts(df, [seeded_hash(key, seed)], ends, [target])
    except SharedHash:
        ranked = hash_rank(df, key, seed, [target])
        size, rank = F.col("stratum_size"), F.col("hash_rank")
        share = lambda f: F.floor((2 * size * f.numerator + f.denominator) / (2 * f.denominator))
        return ranked.withColumn(
            "split", F.when(rank <= share(test), "test").when(rank <= share(test) + share(validation), "validation")
            .otherwise("train")).drop("hash_rank", "stratum_size")
    h = seeded_hash(key, seed)
    return df.withColumn("split", F.when(cuts.below(h, slot=0), "test").when(cuts.below(h, slot=1), "validation").otherwise("train"))


def balanced_weight(df: DataFrame, target: str) -> Column:
    """n / (2 * class size) per row, from one tiny aggregate."""
    row = df.agg(F.count("*").alias("n"), F.sum(F.col(target).cast("long")).alias("p")).first()
    n, pos = row["n"], row["p"] or 0
    if not 0 < pos < n:
        raise ValueError("both classes are needed")
    return F.when(F.col(target) == 1, n / (2.0 * pos)).otherwise(n / (2.0 * (n - pos)))


def positive_weight(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Negatives per positive."""
    return df.agg(F.count_if(F.col(target) == 0).alias("n_negative"),
                  F.count_if(F.col(target) == 1).alias("n_positive")).withColumn(
        "scale_pos_weight", F.try_divide("n_negative", "n_positive"))
