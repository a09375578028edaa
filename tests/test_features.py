from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.functions import features as fx, scoring as sc
from keepwell.operators import encode
from keepwell.operators.quantiles import bin_index, exact_median, exact_quantiles, quantile_edges
from keepwell.schema import CANONICAL_COLUMNS, CONTRACT_LEVELS, active_groups, align, schema_findings


def test_blank_total_becomes_median_not_zero(spark):
    df = spark.createDataFrame([("a", "100", "Yes"), ("b", "200", "No"), ("c", " ", "No"), ("d", "400", "Yes")],
                               "customerID string, TotalCharges string, Churn string")
    typed = fx.typed(df)
    median = exact_median(typed, "TotalCharges")
    got = {r["customerID"]: r["TotalCharges"] for r in typed.fillna({"TotalCharges": median}).collect()}
    assert median == 200.0 and got["c"] == 200.0 and got["d"] == 400.0


def test_bucket_edges(spark):
    rows = [(6, 34.99), (7, 35.0), (12, 65.0), (24, 89.99), (48, 90.0), (49, 10.0)]
    df = spark.createDataFrame(rows, "t int, m double")
    from keepwell.schema import SPEND_DEFAULT, SPEND_EDGES, TENURE_DEFAULT, TENURE_EDGES
    out = df.select(fx.bucket(F.col("t"), TENURE_EDGES, TENURE_DEFAULT, True).alias("a"),
                    fx.bucket(F.col("m"), SPEND_EDGES, SPEND_DEFAULT, False).alias("b")).collect()
    assert [r["a"] for r in out] == ["0-6m", "6-12m", "6-12m", "1-2y", "2-4y", "4y+"]
    assert [r["b"] for r in out] == ["low", "medium", "high", "high", "premium", "low"]


def test_engineered(raw):
    out = {r["customerID"]: r for r in fx.with_engineered(fx.typed(raw)).collect()}
    first = out["C0000"]
    assert first["avg_monthly_spend"] == first["MonthlyCharges"] and first["charges_ratio"] == 1.0
    assert out["C0002"]["num_addon_services"] == 0          # no internet is not a declined add-on
    assert out["C0000"]["num_addon_services"] == 3


def test_canonical_and_alignment(raw):
    full = fx.with_engineered(fx.typed(raw))
    lower = full.withColumnsRenamed({c: c.lower() for c in full.columns})
    assert fx.canonical(lower).columns == CANONICAL_COLUMNS
    with pytest.raises(ValueError):
        fx.canonical(lower.drop("tenure"))
    with pytest.raises(ValueError):
        align(raw, ["tenure", "absent"])
    assert fx.ensure_engineered(raw, ["tenure"]) is raw
    assert "TotalCharges" in active_groups(raw.columns)[2]


def test_schema_findings(raw):
    assert {r["status"] for r in schema_findings(raw).collect()} == {"ok"}
    assert "type differs" in {r["status"] for r in schema_findings(raw.withColumn("tenure", F.lit("x"))).collect()}
    with pytest.raises(ValueError):
        schema_findings(raw.drop("Churn"))


def test_bands(spark):
    df = spark.createDataFrame([(p,) for p in (0.95, 0.61, 0.6, 0.5, 0.41, 0.4, 0.01)], "p double")
    assert [r[0] for r in df.select(sc.risk_category(F.col("p"))).collect()] == [
        "High", "High", "Medium", "Medium", "Medium", "Low", "Low"]
    assert [r[0] for r in df.select(sc.risk_band_sortable(F.col("p"))).collect()][2:6] == [
        "1 - High", "2 - Medium", "2 - Medium", "2 - Medium"]
    assert [r[0] for r in df.select(sc.hard_prediction(F.col("p"))).collect()] == [1, 1, 1, 1, 0, 0, 0]
    with pytest.raises(ValueError):
        sc.target_population(df, 0.99, "p")


def test_text_helpers(spark):
    df = spark.createDataFrame([("nominal__Contract_One year", "avg_monthly", {"tenure": 1.26})], "a string, b string, m map<string,double>")
    row = df.select(sc.strip_prefix(F.col("a")), sc.caption(F.col("b")), sc.sd_map_text(F.col("m"))).first()
    assert tuple(row) == ("Contract_One year", "Avg Monthly", "tenure (+1.3 SD)")


@pytest.mark.parametrize("kind", ["uniform", "ties", "hot"])
@pytest.mark.parametrize("parts", [1, 7])
def test_exact_quantiles_match_numpy(spark, kind, parts):
    rng = np.random.default_rng(5)
    n = 24_001
    values = {"uniform": rng.random(n), "ties": rng.integers(0, 40, n).astype(float),
              "hot": np.where(rng.random(n) < 0.4, 0.5, rng.random(n))}[kind]
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(parts)
    qs = [Fraction(i, 10) for i in range(11)]
    got = exact_quantiles(df, {"v": "v"}, qs)["v"]
    assert np.allclose(got, np.quantile(values, [float(q) for q in qs]), rtol=0, atol=1e-12)


def test_quantile_brackets_close_in(spark, monkeypatch):
    from keepwell.operators import quantiles
    monkeypatch.setattr(quantiles, "FEW", 5)
    monkeypatch.setattr(quantiles, "BINS", 4)
    rng = np.random.default_rng(1)
    wide = np.r_[rng.normal(size=900), rng.normal(size=50) * 1e250, [1e308, -1e308] * 3]
    many = np.r_[np.full(500, 2.5), rng.normal(size=456)]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(wide, many)], "a double, b double").repartition(3)
    qs = [Fraction(i, 7) for i in range(8)]
    got = exact_quantiles(df, {"a": "a", "b": "b"}, qs)
    for c, values in (("a", wide), ("b", many)):
        s = np.sort(values)
        for q, v in zip(qs, got[c]):
            pos = q * (len(s) - 1)
            low = pos.numerator // pos.denominator
            high = min(low + (pos.denominator != 1), len(s) - 1)
            assert v == (s[low] if s[low] == s[high] else s[low] + (s[high] - s[low]) * float(pos - low))


def test_quantiles_of_infinities_and_nan(spark):
    values = [float("-inf"), float("inf"), float("inf"), float("nan"), 1.0, 2.0, 3.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_quantiles(df, {"v": "v"}, [Fraction(i, 6) for i in range(7)])["v"]
    assert got[:6] == [float("-inf"), 1.0, 2.0, 3.0, float("inf"), float("inf")] and got[6] != got[6]


def test_quantile_bins_are_right_closed(spark):
    import pandas as pd
    values = [0.1, 0.1, 0.2, 0.3, 0.3, 0.3, 0.4, 0.8, 0.9, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(bin_index(F.col("v"), quantile_edges(df, "v", 4))).collect()]
    assert got == pd.qcut(values, 4, labels=False, duplicates="drop").tolist()


def test_all_null_quantile(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_median(df, "v") is None


def test_codes_and_one_hot(spark):
    from pyspark.ml import Pipeline
    train = spark.createDataFrame([("b", "One year", 1.0), ("a", "Two year", 2.0)], "x string, Contract string, n double")
    other = spark.createDataFrame([("z", "?", 1.0), (None, None, 1.0), ("a", "Month-to-month", 0.0)], "x string, Contract string, n double")
    levels = encode.pinned_levels(train, ["x"])
    assert levels == {"x": ["a", "b"]}
    assert [tuple(r) for r in other.select(encode.category_code("x", levels["x"]), encode.contract_code()).collect()] == [(-1, -1), (-1, -1), (0, 0)]
    prep = lambda d: d.withColumn("Contract_code", encode.contract_code().cast("double"))
    fitted = Pipeline(stages=encode.linear_stages(["x"], ["Contract"], ["n"])).fit(prep(train))
    rows = [r["features"].toArray().tolist() for r in fitted.transform(prep(other)).collect()]
    assert rows == [[0.0, 0.0, -1.0, 1.0], [0.0, 0.0, -1.0, 1.0], [1.0, 0.0, 0.0, 0.0]]


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    terms = {"a": F.col("a"), "b": F.col("b")}
    assert encode.scaling(df, terms) == {"a": (2.0, 1.0), "b": (5.0, 1.0)}


def test_split_counts_and_partition_invariance(spark):
    df = spark.createDataFrame([(f"c{i}", int(i % 4 == 0)) for i in range(1003)], "customerID string, Churn int")
    one = encode.stratified_split(df.repartition(1), "customerID", 42)
    many = encode.stratified_split(df.repartition(16), "customerID", 42)
    assert one.select("customerID", "split").exceptAll(many.select("customerID", "split")).isEmpty()
    counts = {(r["Churn"], r["split"]): r["count"] for r in one.groupBy("Churn", "split").count().collect()}
    assert counts[1, "test"] == 50 and counts[0, "test"] == 150 and counts[1, "train"] == 151


def test_hash_rank_in_one_hot_stratum(spark):
    from keepwell.operators.ranking import hash_rank
    df = spark.createDataFrame([(f"k{i}", "hot" if i % 3 else "cold") for i in range(3000)], "k string, s string")
    ranked = hash_rank(df, "k", 7, ["s"])
    from pyspark.sql import Window
    plain = df.withColumn("r", F.row_number().over(Window.partitionBy("s").orderBy(F.md5(F.concat_ws(":", "k", F.lit("7"))), "k")))
    assert ranked.join(plain, "k").filter("hash_rank <> r").isEmpty()
    shuffled = hash_rank(df, "k", 7, ["s"], digits=2)
    assert shuffled.join(plain, "k").filter("hash_rank <> r").isEmpty()
