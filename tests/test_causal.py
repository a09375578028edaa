import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.operators import causal, matching
from keepwell.operators.causal import saturated_propensity
from keepwell.plans.observational import refute, run_observational


def greedy(score, treated, caliper):
    """Direct sequential matching: highest treated first, nearest free control."""
    free = np.flatnonzero(treated == 0).tolist()
    pairs = []
    for t in sorted(np.flatnonzero(treated == 1), key=lambda i: -score[i]):
        if not free:
            break
        gaps = [abs(score[c] - score[t]) for c in free]
        j = int(np.argmin(gaps))
        if gaps[j] <= caliper:
            pairs.append((score[t], score[free.pop(j)]))
    return sorted(pairs)


def frame(spark, score, treated, outcome=None):
    outcome = np.zeros(len(score)) if outcome is None else outcome
    return spark.createDataFrame([(f"u{i}", float(s), int(t), int(y)) for i, (s, t, y) in enumerate(zip(score, treated, outcome))],
                                 "customerID string, score double, treated int, outcome int")


@pytest.mark.parametrize("seed,share", [(0, 0.3), (1, 0.5), (2, 0.8)])
def test_sweep_equals_sequential_greedy(seed, share):
    rng = np.random.default_rng(seed)
    for caliper in (0.02, 0.3, 5.0):
        score = rng.normal(size=400)
        treated = (rng.random(400) < share).astype(int)
        order = np.argsort(-score)
        flows, _ = matching.sweep(score[order].tolist(), treated[order].tolist(), (1 - treated[order]).tolist(), caliper)
        assert sorted((f[0], f[2]) for f in flows) == greedy(score, treated, caliper)


def test_tied_scores_match_greedy_score_pairs():
    rng = np.random.default_rng(5)
    grid = np.array([0.0, 0.11, 0.23, 0.37, 0.52, 0.68, 0.85, 1.03])
    score = grid[rng.integers(0, 8, 300)]
    treated = (rng.random(300) < 0.45).astype(int)
    values = np.unique(score)[::-1]
    nt = [int(((score == v) & (treated == 1)).sum()) for v in values]
    nc = [int(((score == v) & (treated == 0)).sum()) for v in values]
    flows, _ = matching.sweep(values.tolist(), nt, nc, 0.4)
    got = sorted((f[0], f[2]) for f in flows for _ in range(f[4]))
    assert got == greedy(score, treated, 0.4)


def test_pairs_do_not_depend_on_slabs(spark):
    rng = np.random.default_rng(8)
    score = np.round(rng.normal(size=1500), 2)
    score[:500] = 0.25                                  # a third of all units share one score
    units = frame(spark, score, (rng.random(1500) < 0.5).astype(int))
    one = matching.match_pairs(units.repartition(1), "customerID", "score", "treated", 0.1)
    many = matching.match_pairs(units.repartition(8), "customerID", "score", "treated", 0.1, slab_scores=12)
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
    n = one.count()
    assert one.select("treated_id").distinct().count() == n == one.select("control_id").distinct().count()
    assert one.agg(F.max("distance")).first()[0] <= 0.1
    info = matching.match_info(units, one, "treated", 0.1).first()
    assert info["n_matched_pairs"] == n and info["n_treated"] == n + info["n_unmatched_treated"]


def test_hopeless_matching_gives_no_pairs(spark):
    units = frame(spark, [5.0] * 20 + [-5.0] * 20, [1] * 20 + [0] * 20)
    assert matching.match_pairs(units, "customerID", "score", "treated", 0.2).isEmpty()


def confounded(spark, effect, n=4000, seed=0):
    """Customers whose tenure drives both uptake and outcome."""
    rng = np.random.default_rng(seed)
    tenure = rng.integers(0, 12, n)
    treated = rng.random(n) < 0.2 + 0.05 * tenure
    churn = rng.random(n) < np.clip(0.7 - 0.045 * tenure + effect * treated, 0, 1)
    fixed = {"Contract": "One year", "InternetService": "DSL", "PaymentMethod": "Mailed check", "PaperlessBilling": "No",
             "Partner": "No", "Dependents": "No", "SeniorCitizen": 0, "gender": "Male", "PhoneService": "Yes", "MultipleLines": "No"}
    df = spark.createDataFrame([(f"u{i:05d}", int(t), int(d), int(y), int(i % 3)) for i, (t, d, y) in enumerate(zip(tenure, treated, churn))],
                               "customerID string, tenure int, treated int, outcome int, num_other_addons int")
    return df.withColumns({k: F.lit(v) for k, v in fixed.items()}).withColumn("MonthlyCharges", F.lit(50.0))


def test_balance_reads_stored_units_and_pairs(spark, monkeypatch):
    from keepwell.plans import catalog
    monkeypatch.setattr(catalog, "observational", lambda spark, folder: confounded(spark, -0.10, 600))
    units, terms, pairs = catalog.matched(spark, "")
    assert units.storageLevel.useDisk and pairs.storageLevel.useDisk       # else the planner unfolds both models in the join
    rows = {r["customerID"]: r["tenure"] for r in units.collect()}
    taken = [rows[i] for r in pairs.collect() for i in (r["treated_id"], r["control_id"])]
    t, c = np.array(taken[::2], float), np.array(taken[1::2], float)
    got = {r["covariate"]: r["smd_after"] for r in catalog.match_balance(spark, "").collect()}
    assert len(t) and got["tenure"] == pytest.approx((t.mean() - c.mean()) / np.sqrt((t.var() + c.var()) / 2))
    spark.catalog.clearCache()


def test_estimators_recover_effect_where_naive_fails(spark):
    units = confounded(spark, -0.10).persist()
    out = run_observational(units, "customerID", seed=1)
    est = {r["estimator"]: r["estimate"] for r in out["estimates"].collect()}
    naive = out["naive"].first()["naive_difference"]
    assert abs(naive + 0.10) > 0.08
    for name in ("matching_att", "ipw_ate", "aipw_ate"):
        assert abs(est[name] + 0.10) < 0.05, name
    row = {r["covariate"]: r for r in out["balance"].collect()}["tenure"]
    assert abs(row["after_matching"]) < abs(row["before"]) and abs(row["after_weighting"]) < 0.1
    assert out["overlap"].first()["n_total"] == 4000
    wide = saturated_propensity(causal.design_cells(units, ["tenure"]), ["tenure"])
    assert abs(causal.aipw_saturated(wide).first()[0] + 0.10) < 0.05


def test_null_effect_and_refuters(spark):
    units = confounded(spark, 0.0, seed=3).persist()
    cells = causal.design_cells(units, ["tenure"]).withColumn("run", F.lit(0))
    att = causal.line_att(saturated_propensity(cells, ["tenure"], by=["run"]), ["run"], 0.2).first()["matching_att"]
    assert abs(att) < 0.05
    placebo = causal.placebo_treatments(units, "customerID", 4, 1)
    n_t = units.agg(F.sum("treated")).first()[0]
    assert set(placebo.agg(*[F.sum(F.col("arms")[r]) for r in range(4)]).first()) == {n_t}
    assert placebo.filter("arms[0] != arms[1]").count() > 500
    subset = causal.subset_samples(units, "customerID", 4, 1)
    assert set(subset.agg(*[F.sum(F.col("w")[r]) for r in range(4)]).first()) == {2800}
    verdict = {r["refuter"]: r for r in causal.refutation(
        att, causal.run_effects(placebo, ["tenure"]), causal.run_effects(subset, ["tenure"])).collect()}
    assert verdict["placebo_treatment"]["passes"] and verdict["random_subset"]["passes"]


def test_line_effect_equals_pair_effect(spark):
    rng = np.random.default_rng(2)
    score = rng.normal(size=500)                        # all scores differ, so both forms match the same units
    treated, outcome = (rng.random(500) < 0.4).astype(int), (rng.random(500) < 0.3).astype(int)
    units = frame(spark, score, treated, outcome)
    pairs = matching.match_pairs(units, "customerID", "score", "treated", carry=["outcome"])
    line = units.select("score", F.col("treated").cast("double").alias("n_t"), (1.0 - F.col("treated")).alias("n_c"),
                        (F.col("treated") * F.col("outcome")).cast("double").alias("y_t"),
                        ((1 - F.col("treated")) * F.col("outcome")).cast("double").alias("y_c"))
    a, b = matching.att(pairs).first(), matching.att_on_line(line, slab_scores=100).first()
    assert a["n_pairs"] == b["n_pairs"] and a["att"] == pytest.approx(b["matching_att"])


def test_logistic_refuters(spark):
    units = confounded(spark, -0.10, n=1500, seed=6).persist()
    out = {r["refuter"]: r for r in refute(units, "customerID", -0.10, runs=2).collect()}
    assert abs(out["placebo_treatment"]["mean_estimate"]) < 0.08 and out["random_subset"]["n_runs"] == 2


def test_bootstrap_is_partition_invariant_and_covers(spark):
    units = confounded(spark, -0.10, seed=4)
    cells = causal.design_cells(units, ["tenure"])
    a = {r["estimator"]: r for r in causal.bootstrap(cells.repartition(1), ["tenure"], draws=60).collect()}
    b = {r["estimator"]: r for r in causal.bootstrap(cells.repartition(5), ["tenure"], draws=60).collect()}
    for name, r in a.items():
        assert r["ci_low"] == pytest.approx(b[name]["ci_low"]) and r["bootstrap_se"] > 0
        assert r["ci_low"] < -0.05 and r["ci_high"] > -0.15
    few = causal.bootstrap(cells, ["tenure"], draws=10).first()
    assert few["ci_low"] is None


def test_bootstrap_with_callable(spark):
    cells = causal.design_cells(confounded(spark, -0.1, n=600), ["tenure"])
    rate = lambda c: c.agg(F.sum(F.col("n") * F.col("outcome")) / F.sum("n")).first()[0]
    row = causal.bootstrap_with(rate, cells, ["tenure", "treated", "outcome"], 20).first()
    assert row["draws"] == 20 and row["ci_low"] < row["ci_high"]


def test_overlap_ends_are_inclusive(spark):
    cells = spark.createDataFrame([(1, 0.1, 1.0), (1, 0.9, 1.0), (0, 0.1, 1.0), (0, 0.5, 1.0), (0, 0.01, 1.0)],
                                  "treated int, propensity double, n double")
    row = causal.overlap(cells).first()
    assert (row["low"], row["high"], row["n_in_support"]) == (0.1, 0.5, 3)


def test_e_value(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (0.5,)], "rr double")
    one, two, half = [r[0] for r in df.select(causal.e_value(F.col("rr"))).collect()]
    assert one == 1.0 and two == half == pytest.approx(2 + 2 ** 0.5)


def panel(spark, drift, effect=-0.08, n=6000, seed=0):
    rng = np.random.default_rng(seed)
    g = rng.integers(0, 2, n)
    rows = []
    for period in (-2, -1, 0):
        p = 0.3 + 0.1 * g + 0.05 * (period == 0) + effect * g * (period == 0) + drift * g * (period + 2)
        rows += [(period, int(period == 0), int(a), int(b)) for a, b in zip(g, rng.random(n) < p)]
    return spark.createDataFrame(rows, "period int, post int, treated_group int, churned int")


def test_difference_in_differences(spark):
    p = panel(spark, 0.0)
    cells = causal.panel_cells(p).first()
    term = causal.did_regression(p).term("did")
    assert cells["did_estimate"] == pytest.approx(term["coefficient"], abs=1e-9)
    assert abs(cells["did_estimate"] + 0.08) < 0.04 < abs(cells["naive_post_period"] + 0.08)
    assert causal.parallel_trends(p).first()["trends_parallel"]
    assert not causal.parallel_trends(panel(spark, 0.15)).first()["trends_parallel"]
    assert not causal.parallel_trends(p.filter("period > -2")).first()["testable"]


def test_eligibility(spark, raw):
    out = causal.prepare_observational(raw.withColumn("Churn", F.lit(0)).withColumn("TotalCharges", F.lit(1.0)))
    assert out.count() == 8 and {r["treated"] for r in out.collect()} == {0, 1}
    first = out.filter("customerID = 'C0000'").first()
    assert first["num_other_addons"] == first["num_addon_services"] - 1


def plain_newton(x, y, w, scale, l2):
    """Ridge logistic fit of one data set in numpy."""
    mean = np.average(x, axis=0, weights=scale)
    sd = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=scale))
    z = np.column_stack([np.ones(len(x)), (x - mean) / np.where(sd > 1e-9, sd, 1)])
    pen = np.r_[0.0, np.full(x.shape[1], l2)]
    b = np.zeros(z.shape[1])
    for _ in range(60):
        mu = 1 / (1 + np.exp(-z @ b))
        b = b + np.linalg.solve((z.T * (w * mu * (1 - mu))) @ z + np.diag(pen), z.T @ (w * (y - mu)) - pen * b)
    return 1 / (1 + np.exp(-z @ b))


def weighted_design(spark, n=300, draws=5, seed=9):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(50, 9, n), rng.integers(0, 2, n), np.full(n, 3.0), rng.normal(size=n) * 1e-3])
    t = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - 50) / 9 - x[:, 1]))).astype(int)
    y = (rng.random(n) < 0.3 + 0.2 * t).astype(int)
    w = rng.poisson(1, (n, draws))
    w[:, 1] = w[:, 1] * t                                # a replicate without controls
    w[:, 2] = 0                                          # and one without rows
    w[:, 3] = w[:, 3] * (x[:, 1] == 1)                   # a term that is constant in a replicate
    df = spark.createDataFrame([(list(map(float, a)), int(b), int(c), list(map(int, d))) for a, b, c, d in zip(x, t, y, w)],
                               "x array<double>, treated int, outcome int, w array<int>")
    return x, t, y, w, df.repartition(3)


def test_batched_fits_equal_single_fits(spark):
    x, t, y, w, df = weighted_design(spark)
    fitted = causal.fit_replicates(df, list("abcd"), 5)
    got = fitted.propensity.probability(x)
    for r in (0, 3, 4):
        assert got[:, r] == pytest.approx(plain_newton(x, t, w[:, r], w[:, r], 1.0), abs=1e-7)
    assert fitted.propensity.rate[1] == 1.0 and np.isnan(got[:, 2]).all() and not fitted.propensity.converged[2]
    assert (fitted.propensity.weights[:, 2] == 0).all() and fitted.propensity.weights[3, 1] == 0
    m = fitted.outcome.probability(x)
    for arm in (0, 1):
        assert m[:, 5 * arm + 4] == pytest.approx(plain_newton(x, y, w[:, 4] * (t == arm), w[:, 4], 1.0), abs=1e-7)
    residual = causal.score_equations(fitted).filter("replicate in (0, 3, 4)").agg(F.max(F.abs("residual"))).first()[0]
    assert residual < 1e-9


def test_batched_estimates_equal_plain_ones(spark):
    x, t, y, w, df = weighted_design(spark)
    fitted = causal.fit_replicates(df, list("abcd"), 5)
    rows = {r[0]: r for r in fitted.weighted()}
    assert rows[1][1:] == (None, None, None) and rows[2][1:] == (None, None, None)
    q = np.clip(plain_newton(x, t, w[:, 4], w[:, 4], 1.0), 0.01, 0.99)
    m1, m0 = (plain_newton(x, y, w[:, 4] * (t == a), w[:, 4], 1.0) for a in (1, 0))
    robust = np.average(m1 - m0 + t * (y - m1) / q - (1 - t) * (y - m0) / (1 - q), weights=w[:, 4])
    by_weight = np.average(y, weights=w[:, 4] * t / q) - np.average(y, weights=w[:, 4] * (1 - t) / (1 - q))
    assert rows[4][1] == pytest.approx(by_weight, abs=1e-7) and rows[4][2] == pytest.approx(robust, abs=1e-7)
    att = {r["replicate"]: r for r in fitted.matched().collect()}
    score = np.round(np.log(np.clip(fitted.propensity.probability(x)[:, 4], 1e-6, 1 - 1e-6) / (1 - np.clip(fitted.propensity.probability(x)[:, 4], 1e-6, 1 - 1e-6))), 12)
    units = np.repeat(np.arange(len(x)), w[:, 4])
    caliper = 0.2 * score[units].std()
    pairs = greedy(score[units], t[units], caliper)
    assert att[4]["n_pairs"] == len(pairs) and set(att) == {0, 3, 4}


def test_lines_in_slabs_equal_one_slab(spark):
    rng = np.random.default_rng(12)
    rows = []
    for line in range(3):
        score = np.round(np.r_[rng.normal(size=200), [9.0, 9.01] * (line == 1)], 3)
        rows += [(line, float(s), *(float(v) for v in (t, c, t * 0.5, c * 0.25))) for s, t, c in zip(score, rng.integers(0, 4, len(score)), rng.integers(0, 3, len(score)))]
    lines = spark.createDataFrame(rows, "line int, score double, n_t double, n_c double, y_t double, y_c double")
    one = sorted(map(tuple, matching.lines_att(lines, ["line"], 1.5).collect()))
    many = sorted(map(tuple, matching.lines_att(lines, ["line"], 1.5, slab_scores=15).collect()))
    assert [r[:2] for r in one] == [r[:2] for r in many] and [r[2] for r in one] == pytest.approx([r[2] for r in many])


def test_model_bootstrap_covers(spark):
    units = confounded(spark, -0.10, n=1500, seed=4)
    out = run_observational(units, "customerID", draws=40, seed=1)["estimates"].collect()
    assert all(r["ci_low"] < r["estimate"] < r["ci_high"] and r["ci_high"] - r["ci_low"] < 0.25 for r in out)


def test_failed_fits_raise(spark):
    units = confounded(spark, -0.1, n=50).withColumn("treated", F.lit(1))
    with pytest.raises(ValueError):
        causal.fit_logistic(units, {"tenure": F.col("tenure")}, F.col("treated"))
