import itertools

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from keepwell.functions.features import typed, with_engineered
from keepwell.functions.scoring import risk_category
from keepwell.operators import cluster, contributions as contrib, metrics, models, profile, segments
from keepwell.plans import publish
from keepwell.schema import TARGET
from keepwell.session import scratch_folder
from keepwell.sources import store
from keepwell.streaming import scoring as online


def test_drift_thresholds_are_strict(spark):
    base = spark.createDataFrame([("a", 10.0, 1.0), ("b", 10.0, 1.0)], "feature string, mean double, std double")
    now = spark.createDataFrame([("a", 11.0, 1.0), ("b", 11.1, 1.0)], "feature string, mean double, std double")
    assert {r["feature"]: r["drifted"] for r in profile.numeric_drift(base, now).collect()} == {"a": False, "b": True}


def test_categorical_drift_lists_levels(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "c string")
    b = spark.createDataFrame([("x",), ("z",)], "c string")
    row = profile.categorical_drift(profile.categorical_baseline(a, ["c"]), profile.categorical_baseline(b, ["c"])).first()
    assert row["tvd"] == pytest.approx(0.5) and row["new_categories"] == ["z"] and row["missing_categories"] == ["y"]
    with pytest.raises(RuntimeError):
        publish.require_no_drift(spark.createDataFrame([("c", "categorical")], "feature string, kind string"))
    publish.require_no_drift(spark.createDataFrame([], "feature string, kind string"))


def test_segment_report_and_names(spark, raw):
    full = with_engineered(typed(raw).fillna({"TotalCharges": 0.0}))
    assert segments.churn_by_segment(full, 20).isEmpty() and segments.churn_by_segment(full, 1).count() > 3
    rows = [(0, 100, 0.9, 5.0, 100.0, 0.9), (1, 100, 0.9, 5.0, 100.0, 0.9), (2, 100, 0.1, 50.0, 20.0, 0.1), (3, 100, 0.1, 60.0, 110.0, 0.1)]
    prof = spark.createDataFrame(rows, "segment int, customers long, churn_rate double, avg_tenure double, avg_monthly_charges double, pct_month_to_month double")
    names = {r["segment"]: r["name"] for r in segments.name_segments(prof).collect()}
    assert len(set(names.values())) == 4 and names[1] in ("High-Value At Risk (1)", "New and Unsettled (1)")
    assert names[2] == "Locked-In Core" and names[3] == "Premium Loyalists"


def blobs(spark):
    rng = np.random.default_rng(0)
    truth = rng.integers(0, 3, 300)
    x = rng.normal(size=(300, 2)) * 0.4 + np.array([[0, 0], [5, 5], [0, 6]])[truth]
    df = spark.createDataFrame([(f"p{i:03d}", float(a), float(b), int(t)) for i, ((a, b), t) in enumerate(zip(x, truth))],
                               "customerID string, a double, b double, truth int")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df), x, truth


def test_clusters_found_scored_and_stable(spark):
    points, x, truth = blobs(spark)
    scores = cluster.sweep_k(points, range(2, 5), restarts=2, inputs=["a", "b"])
    assert metrics.choose_k(scores).first()["k"] == 3
    fit = cluster.fit_kmeans(points, 3, 3, inputs=["a", "b"])
    labels = fit.assign(points, ["a", "b"])
    assert metrics.adjusted_rand(labels, "segment", "truth").first()[0] == pytest.approx(1.0)
    cross = cluster.second_opinion(points, labels, 3, "customerID", inputs=["a", "b"])
    assert cross.first()[0] > 0.9
    again = cluster.resample_agreement(points, fit, "customerID", runs=2, restarts=2, inputs=["a", "b"])
    assert cluster.stability(cross, again).first()["stable"]
    row = metrics.cluster_quality(labels, "segment", ["a", "b"]).first()
    lab = np.array([r["segment"] for r in labels.orderBy("customerID").collect()])
    d2 = ((x[:, None] - x[None]) ** 2).sum(-1)
    sil = []
    for i in range(len(x)):
        means = {k: d2[i, lab == k].sum() / ((lab == k).sum() - (k == lab[i])) for k in set(lab)}
        a = means.pop(lab[i]); b = min(means.values()); sil.append((b - a) / max(a, b))
    assert row["silhouette"] == pytest.approx(np.mean(sil), abs=1e-6)


def test_tiny_cluster_is_not_eligible(spark):
    scores = spark.createDataFrame([(2, 0.9, 0.01), (3, 0.5, 0.2)], "k int, silhouette double, smallest_share double")
    assert metrics.choose_k(scores).first()["k"] == 3
    assert metrics.choose_k(scores.filter("k = 2")).first()["k"] == 2


def test_contribution_ranks_and_master(spark):
    df = spark.createDataFrame([("c1", 1.0, 0.0), ("c2", 3.0, 5.0)], "customerID string, x double, y double")
    out = contrib.linear_contributions(df, {"num__x": F.col("x"), "y": F.col("y")}, {"num__x": 2.0, "y": -1.0})
    long = contrib.long_contributions(out)
    got = {(r["customerID"], r["rank_within_customer"]): (r["feature"], r["shap_value"]) for r in long.collect()}
    assert got["c1", 1] == ("y", 2.5) and got["c1", 2] == ("x", -2.0)
    one = {r["customerID"]: r["driver_1_feature"] for r in publish.master_table(out, 2).collect()}
    two = {r["customerID"]: r["driver_1_feature"] for r in contrib.drivers_from_long(long, df, 2).collect()}
    assert one == two and publish.master_table(df).columns == df.columns


def training_rows(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    t, m, k = rng.integers(1, 60, n), rng.uniform(20, 110, n), rng.integers(0, 3, n)
    y = rng.random(n) < 1 / (1 + np.exp(0.06 * t - 0.02 * m + k))
    levels = ["Month-to-month", "One year", "Two year"]
    return spark.createDataFrame([(f"c{i:04d}", int(a), float(b), levels[c], int(d)) for i, (a, b, c, d) in enumerate(zip(t, m, k, y))],
                                 "customerID string, tenure int, MonthlyCharges double, Contract string, Churn int").withColumn(
        "PaymentMethod", F.when(F.col("tenure") % 2 == 0, "Mailed check").otherwise("Electronic check"))


def test_models_save_load_and_unseen_levels(spark):
    train, test = training_rows(spark), training_rows(spark, 200, 1)
    scorer = models.fit_linear(train)
    trees = models.fit_trees(train, test, "boosted_trees", maxIter=5, maxDepth=3)
    table = models.winner(models.candidate_metrics([scorer, trees], test)).collect()
    assert table[0]["deployed"] and sum(r["deployed"] for r in table) == 1 and table[0]["roc_auc"] >= table[1]["roc_auc"] > 0.6
    path = scratch_folder(spark, "scorer")
    scorer.save(path)
    again = models.Scorer.load(spark, path)
    strange = test.withColumn("PaymentMethod", F.lit("Carrier pigeon"))
    a, b = scorer.score(strange).collect(), again.score(strange).collect()
    assert len(a) == 200 and [r["churn_probability"] for r in a] == [r["churn_probability"] for r in b]
    with pytest.raises(ValueError):
        scorer.score(test.drop("tenure"))
    trials, best = models.search_trees(train, test, [{"maxIter": 2, "maxDepth": 2}, {"maxIter": 4, "maxDepth": 3}])
    assert trials.count() == 2 and best["maxDepth"] in (2, 3)


def test_tree_contributions_match_brute_force(spark):
    train = training_rows(spark)
    scorer = models.fit_trees(train, train, "boosted_trees", maxIter=3, maxDepth=3)
    path = scratch_folder(spark, "trees")
    model = scorer.pipeline.stages[-1]
    model.write().overwrite().save(path)
    nodes = contrib.tree_nodes(spark, path)
    columns = scorer.shape.code_columns
    rows = scorer.shape.prepare(train.limit(20))
    got = contrib.tree_contributions(rows, nodes, model.treeWeights, columns, columns).collect()
    trees = contrib._load_trees(nodes)

    def expected(tree, node, x, known):
        left, right = tree["left"][node], tree["right"][node]
        if left < 0:
            return tree["value"][node]
        f = tree["feature"][node]
        if f in known:
            return expected(tree, left if contrib._follows_left(tree, node, x)[0] else right, x, known)
        wl, wr = tree["cover"][left], tree["cover"][right]
        return (wl * expected(tree, left, x, known) + wr * expected(tree, right, x, known)) / (wl + wr)

    from math import factorial
    m = len(columns)
    for r in got[:3]:
        x = np.array([[e["feature_value"] for e in r["contributions"]]])
        value = lambda s: sum(w * expected(t, 0, x, s) for t, w in zip(trees, model.treeWeights))
        for i in range(m):
            rest = [j for j in range(m) if j != i]
            phi = sum(factorial(len(s)) * factorial(m - len(s) - 1) / factorial(m) * (value({*s, i}) - value(set(s)))
                      for k in range(m) for s in itertools.combinations(rest, k))
            assert r["contributions"][i]["shap_value"] == pytest.approx(phi, abs=1e-9)


def test_stream_equals_batch_and_contract(spark, raw):
    folder = scratch_folder(spark, "stream")
    frame = typed(raw).drop(TARGET)
    bad = spark.createDataFrame([('{"tenure": "many"}',), ("{broken",)], "value string")
    values = frame.select(F.to_json(F.struct("*")).alias("value")).unionByName(
        frame.limit(1).withColumn("tenure", F.lit(-1)).fillna({"TotalCharges": 1.0}).select(F.to_json(F.struct("*")).alias("value"))).unionByName(bad)
    values.write.text(f"{folder}/in")
    score = lambda d: d.withColumn("churn_probability", 1 / (1 + F.exp(-(F.col("num_addon_services") - F.col("charges_ratio")))))
    records = online.parse(spark.readStream.schema("value string").text(f"{folder}/in"))
    online.run_stream(records, score, "v1", "m", f"{folder}/out", f"{folder}/state")
    batch = online.score_records(online.parse(values), score, "v1", "m")
    stream = spark.read.parquet(f"{folder}/out")
    assert stream.exceptAll(batch).isEmpty() and batch.exceptAll(stream).isEmpty() and stream.count() == 11
    rejected = online.quarantine(online.parse(values)).collect()
    assert len(rejected) == 4 and any("negative tenure" in r["problems"] for r in rejected)
    assert any("malformed" in r["problems"] for r in rejected)


def test_runs_ledger_and_gate(spark):
    path = scratch_folder(spark, "runs")
    one = spark.createDataFrame([("a", 0.7)], "model string, roc_auc double")
    store.write_run(one, path, "20260101-000000")
    store.write_run(one.withColumn("roc_auc", F.lit(0.78)), path, "20260102-000000")
    store.write_run(one.withColumn("roc_auc", F.lit(0.1)), path, "latest")
    newest = store.newest_run(store.read_runs(spark, path))
    assert newest.first()["roc_auc"] == 0.78
    gate = publish.model_gate(newest.withColumn("deployed", F.lit(True))).first()
    assert gate["passed"] and "meets" in gate["reason"]
    with pytest.raises(FileNotFoundError):
        store.newest_run(spark.createDataFrame([("x",)], "run_ts string"))
    ledger = scratch_folder(spark, "ledger")
    store.append_ledger(store.ledger_rows(spark, "20260101-000000", "winner", {"model_name": "a"}), ledger)
    store.append_ledger(store.ledger_rows(spark, "20260102-000000", "winner", {"model_name": "b"}), ledger)
    assert {r["model_name"]: r["version"] for r in store.model_versions(spark.read.parquet(ledger)).collect()} == {"a": 1, "b": 2}
    store.promote(spark, scratch_folder(spark, "promotions"), "20260102-000000", "b", 0.78)


def test_files_round_trip(spark, raw, tmp_path):
    store.write_csv(raw, str(tmp_path / "csv"))
    assert store.read_raw_csv(spark, str(tmp_path / "csv")).select("customerID", "tenure").exceptAll(raw.select("customerID", "tenure")).isEmpty()
    store.write_json(raw, str(tmp_path / "json"))
    assert store.read_json(spark, str(tmp_path / "json"), raw.schema).exceptAll(raw).isEmpty()
    store.write_parquet(raw, str(tmp_path / "pq"))
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 12
    assert store.load_table(raw, "raw_customers") == 12 and store.load_table(raw, "raw_customers", "append") == 12
    assert spark.table("raw_customers").count() == 24
    with pytest.raises(ValueError):
        store.load_table(raw, "raw_customers", "upsert")


def test_dictionary_roles(spark):
    df = spark.createDataFrame([("c", 1, 2.0, True)], "customerID string, risk_decile int, revenue double, flag boolean")
    rows = {r["column_name"]: (r["role"], r["datatype"]) for r in publish.data_dictionary({"t": df}).collect()}
    assert rows == {"customerID": ("dimension", "string"), "risk_decile": ("dimension", "integer"),
                    "revenue": ("measure", "real"), "flag": ("dimension", "boolean")}


def test_histogram_density_sums_to_one(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(rng.normal(size=500))], "Churn int, v double")
    out = profile.class_histogram(df, ["v"], "Churn", 30)
    area = out.groupBy("class").agg(F.sum(F.col("density") * (F.col("hi") - F.col("lo")) / 30).alias("a"), F.max("bin").alias("b"))
    assert all(r["a"] == pytest.approx(1.0) and r["b"] == 29 for r in area.collect())


def test_risk_band_defaults(spark):
    assert spark.range(1).select(risk_category(F.lit(0.6))).first()[0] == "Medium"
