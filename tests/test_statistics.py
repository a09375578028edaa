import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from keepwell.functions import tails
from keepwell.operators import experiment as ex, interpret, metrics, power, regression


def arms(spark, st, nt, sc_, nc):
    return spark.createDataFrame([("m", st, nt, sc_, nc)], "metric string, sum_t double, n_t long, sum_c double, n_c long")


def test_tail_values():
    assert tails.t_two_sided(2.228138852, 10) == pytest.approx(0.05, abs=1e-9)
    assert tails.t_quantile(0.975, 10) == pytest.approx(2.228138852, abs=1e-8)
    assert tails.t_quantile(0.975, 1e7) == pytest.approx(1.959964, abs=1e-5)
    assert tails.chi2_tail_one_dof(3.841458821) == pytest.approx(0.05, abs=1e-9)
    assert tails.normal_cdf(1.959963985) == pytest.approx(0.975, abs=1e-9)


def test_equal_proportions(spark):
    row = ex.two_proportion_z(arms(spark, 50.0, 100, 50.0, 100)).first()
    assert row["absolute_difference"] == 0 and row["z_statistic"] == 0 and row["p_value"] == 1.0


def test_degenerate_proportions(spark):
    assert ex.two_proportion_z(arms(spark, 100.0, 100, 100.0, 100)).first()["z_statistic"] == 0.0


def test_chi_square_agrees_with_yates(spark):
    table = spark.createDataFrame([("control", 120, 80), ("treatment", 150, 50)], "`group` string, `0` long, `1` long")
    row = ex.chi_square_2x2(table).first()
    n, a, b, c, d = 400, 120, 80, 150, 50
    want = n * (abs(a * d - b * c) - n / 2) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d))
    assert row["chi2_statistic"] == pytest.approx(want) and row["cramers_v"] == pytest.approx(math.sqrt(want / n))


def test_welch(spark):
    rng = np.random.default_rng(0)
    t, c = rng.normal(1, 2, 300), rng.normal(0, 1, 200)
    df = spark.createDataFrame([("treatment", float(v)) for v in t] + [("control", float(v)) for v in c], "`group` string, x double")
    row = ex.welch_t(ex.arms_wide(df, ["x"])).first()
    se = math.sqrt(t.var(ddof=1) / 300 + c.var(ddof=1) / 200)
    assert row["t_statistic"] == pytest.approx((t.mean() - c.mean()) / se)
    assert row["ci_low"] < row["difference"] < row["ci_high"] and row["significant"]


def test_required_sizes(spark):
    one = spark.range(1)
    n = one.select(power.required_n_proportion(F.lit(0.5), F.lit(0.1))).first()[0]
    assert 380 <= n <= 410
    for base, mde in ((0.0, 0.1), (1.0, 0.1), (0.5, 0.0)):
        with pytest.raises(ValueError):
            power.check_design(base, mde)
        with pytest.raises(Exception):
            one.select(power.required_n_proportion(F.lit(base), F.lit(mde))).collect()
    assert one.select(power.power_at(F.lit(0), F.lit(0.5), F.lit(0.1))).first()[0] == 0.0
    p = one.select(power.power_at(F.lit(n), F.lit(0.5), F.lit(0.1))).first()[0]
    assert p == pytest.approx(0.8, abs=0.01)


def test_power_matches_monte_carlo(spark):
    rng = np.random.default_rng(42)
    n, base, mde = 500, 0.3, 0.08
    a, b = rng.binomial(n, base + mde, 4000) / n, rng.binomial(n, base, 4000) / n
    pool = (a + b) / 2
    z = (a - b) / np.sqrt(2 * pool * (1 - pool) / n)
    formula = spark.range(1).select(power.power_at(F.lit(n), F.lit(base), F.lit(mde))).first()[0]
    assert abs((abs(z) > 1.96).mean() - formula) < 0.05


@pytest.mark.parametrize("family,expected", [
    ({"a": 0.0035, "b": 0.1036}, {"a": True, "b": False}),
    ({"a": 0.03, "b": 0.04}, {"a": False, "b": False})])
def test_holm(spark, family, expected):
    df = spark.createDataFrame(list(family.items()), "metric string, p_value double")
    assert {r["metric"]: r["significant_after_correction"] for r in ex.holm(df).collect()} == expected


def test_verdicts_and_registration(spark):
    rows = [("inconclusive", 0.4, 1292, 292), ("null", 0.8, 1292, 2000), ("significant", 0.003, 1292, 292)]
    df = spark.createDataFrame(rows, "want string, p_value double, required_n_per_arm long, available_n_per_arm long").withColumn("alpha", F.lit(0.05))
    got = power.verdict(df).collect()
    assert all(r["verdict"] == r["want"] for r in got)
    assert [r["inflation_caveat"] for r in got] == [False, False, True]
    designs = spark.createDataFrame([("e", 1, 0.05), ("e", 5, 0.04), ("e", 9, 0.01)], "experiment string, registered_at int, mde double")
    assert power.registered_design(designs, F.lit(7)).first()["mde"] == 0.04


def test_aa_false_positive_rate(spark):
    """Halves of one arm differ no more often than chance allows."""
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(f"c{i}", "control", int(v)) for i, v in enumerate(rng.random(1500) < 0.4)],
                               "customerID string, `group` string, retained int")
    hits = sum(ex.two_proportion_z(ex.arms_wide(ex.same_arm_halves(df, s), ["retained"])).first()["significant"] for s in range(12))
    assert hits <= 3


def test_assignment_balance(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(f"c{i}", float(p)) for i, p in enumerate(rng.random(2000))], "customerID string, churn_probability double")
    a = ex.assign_arms(df.repartition(1), 0.5, 42)
    b = ex.assign_arms(df.repartition(9), 0.5, 42)
    assert a.exceptAll(b).isEmpty()
    per = a.groupBy("risk_stratum").agg(F.count_if(F.col("group") == "treatment").alias("t"), F.count("*").alias("n")).collect()
    assert all(r["t"] == r["n"] // 2 for r in per) and len(per) == 10


def test_auc_spearman(spark):
    rng = np.random.default_rng(2)
    s = np.round(rng.random(4000), 2)
    y = (rng.random(4000) < s).astype(int)
    other = np.round(s + rng.normal(0, .3, 4000), 2)
    df = spark.createDataFrame([(int(a), float(b), float(c)) for a, b, c in zip(y, s, other)], "y int, a double, b double")
    row = metrics.score_agreement(df, "y", "a", "b").first()
    ranks = pd.Series(s).rank()
    pos = y == 1
    auc = (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert row["first_auc"] == pytest.approx(auc, abs=1e-12)
    assert row["spearman_rho"] == pytest.approx(ranks.corr(pd.Series(other).rank()), abs=1e-9)
    assert row["pearson_r"] == pytest.approx(np.corrcoef(s, other)[0, 1], abs=1e-9)


def test_ols_recovers_and_matches_numpy(spark):
    rng = np.random.default_rng(7)
    n = 3000
    x = rng.normal(size=n)
    y = 1 + 2 * x + rng.normal(size=n) * (1 + abs(x))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    fit = regression.ols_hc1(df, F.col("y"), {"const": F.lit(1.0), "x": F.col("x")})
    X = np.column_stack([np.ones(n), x])
    inv = np.linalg.inv(X.T @ X)
    beta = inv @ X.T @ y
    e = y - X @ beta
    cov = inv @ ((X * e[:, None]).T @ (X * e[:, None])) @ inv * n / (n - 2)
    assert np.allclose(fit.beta, beta) and np.allclose(fit.std_error, np.sqrt(np.diag(cov)))


def test_wide_moments_equal_narrow(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 12))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"c{i} double" for i in range(12))).repartition(5)
    assert np.allclose(regression.moments(df, {f"c{i}": F.col(f"c{i}") for i in range(12)}), x.T @ x)


def test_tsls_beats_ols_and_flags_weak(spark):
    rng = np.random.default_rng(11)
    n = 6000
    z, u = rng.integers(0, 2, n), rng.normal(size=n)
    d = (0.8 * z + u + rng.normal(size=n) > 0.5).astype(float)
    y = -0.5 * d + u + rng.normal(size=n)
    frame = lambda dd: spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(z, dd, y)], "z double, d double, y double")
    one = {"const": F.lit(1.0)}
    out = regression.tsls(frame(d), F.col("y"), ("d", F.col("d")), {"z": F.col("z")}, one)
    naive = regression.ols_hc1(frame(d), F.col("y"), {"d": F.col("d"), **one})
    assert abs(out.second.beta[0] + 0.5) < 0.25 < abs(naive.beta[0] + 0.5) and not out.weak_instrument
    noise = rng.normal(size=n)
    assert regression.tsls(frame(noise), F.col("y"), ("d", F.col("d")), {"z": F.col("z")}, one).weak_instrument


def test_vif_and_wald(spark):
    rng = np.random.default_rng(4)
    n = 4000
    a = rng.normal(size=n)
    b, c = a + rng.normal(size=n) * .05, rng.normal(size=n)
    y = (rng.random(n) < 1 / (1 + np.exp(-1.5 * c))).astype(int)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(a, b, c, y)], "a double, b double, c double, y double")
    vif = regression.variance_inflation(df, {k: F.col(k) for k in "abc"})
    assert vif["a"] > 10 and vif["b"] > 10 and vif["c"] < 1.1
    row = interpret.wald_table(df, {"c": F.col("c")}, "y").first()
    assert row["coefficient"] == pytest.approx(1.5, abs=0.15) and row["significant"]
    assert interpret.headline(interpret.wald_table(df, {"c": F.col("c")}, "y")).first()["feature"] == "c"
