"""Stage runners: from raw records to stored tables, runs and extracts.

Each stage is a lazy plan that is materialised once, as a table or as a run
partition. Re-running a stage replaces its own output only.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from keepwell.functions.features import canonical, typed, with_engineered
from keepwell.functions.scoring import target_population
from keepwell.operators import (
    causal, cluster, contributions, experiment as ex, explain, interpret, metrics, models, power, profile, segments,
)
from keepwell.operators.encode import reference_design, stratified_split
from keepwell.operators.quantiles import exact_median
from keepwell.plans import publish, reports
from keepwell.plans.observational import refute, run_observational
from keepwell.schema import ID, RAW_COLUMNS, TARGET, active_groups, drop_non_features, schema_findings
from keepwell.session import for_iteration
from keepwell.sources import store


def feature_stage(raw: DataFrame, prefix: str = "") -> DataFrame:
    """Raw records -> clean, feature and segment tables; returns the features.

    The three tables are replaced as a chain, so a second run gives the same
    rows. Base columns are listed by name: an enriched input cannot duplicate
    a column.
    """
    spark = raw.sparkSession
    schema_findings(raw)
    frame = typed(raw.select(*RAW_COLUMNS))
    median = exact_median(frame, "TotalCharges")
    clean = frame if median is None else frame.fillna({"TotalCharges": median})
    store.load_table(clean, f"{prefix}clean_customers")
    store.load_table(canonical(with_engineered(spark.table(f"{prefix}clean_customers"))), f"{prefix}customer_features")
    features = spark.table(f"{prefix}customer_features")
    store.load_table(segments.churn_by_segment(features), f"{prefix}churn_by_segment")
    return features


def segment_report(spark: SparkSession, prefix: str = "", limit: int = 10) -> DataFrame:
    return segments.by_rate(spark.table(f"{prefix}churn_by_segment"), limit)


def train_stage(features: DataFrame, root: str, run_ts: str, seed=42, tree_params: dict | None = None,
                trials: int = models.SEARCH_TRIALS) -> models.Scorer:
    """Split, search, fit the four candidates, keep the best by test AUC with its baselines.

    Stores under ``root``: the model, the held-out batch, both baselines and
    the ledger of parameters, trials and metrics. Ties go to the later name.
    """
    spark = features.sparkSession
    split = for_iteration(stratified_split(features, ID, seed))
    part = lambda name: split.filter(F.col("split") == name).drop("split")
    train, validation, test = part("train"), part("validation"), part("test")
    params = tree_params or {}
    matrix = models.tree_matrix(train, validation)
    searched, best_draw = models.search_trees(train, validation, [{**d, **params} for d in models.search_space(trials, seed)], matrix)
    trees = {"boosted_trees": {**models.FIRST_TREES, **params}, "boosted_trees_deep": {**models.SECOND_TREES, **params}, "boosted_trees_tuned": best_draw}
    candidates = [models.fit_linear(train), *(models.fit_trees(train, validation, name, matrix=matrix, **p) for name, p in trees.items())]
    matrix[2].unpersist()
    log = lambda scope, entries: store.append_ledger(store.ledger_rows(spark, run_ts, scope, entries), f"{root}/ledger")
    log("run", {"seed": seed, "trials": trials, "train_rows": train.count(), "test_rows": test.count()})
    for name, p in trees.items():
        log(f"params/{name}", p)
    for r in searched.collect():                                           # a row per trial
        log(f"trials/{r['trial']}", {**json.loads(r["params"]), "roc_auc": r["roc_auc"]})
    comparison = models.winner(models.candidate_metrics(candidates, test)).collect()
    for r in comparison:
        log(f"metrics/{r['model']}", {k: float(r[k]) for k in ("roc_auc", "precision", "recall", "f1_score")})
    best = next(r for r in comparison if r["deployed"])
    log("winner", {"model_name": best["model"], "roc_auc": best["roc_auc"]})
    winner = next(c for c in candidates if c.name == best["model"])
    winner.version = run_ts
    winner.save(f"{root}/models/{run_ts}")
    inputs = drop_non_features(train)
    store.write_run(profile.numeric_baseline(inputs), f"{root}/baseline_numeric", run_ts)
    store.write_run(profile.categorical_baseline(inputs), f"{root}/baseline_categorical", run_ts)
    store.write_run(test, f"{root}/scoring_batch", run_ts)
    split.unpersist()
    return winner


def newest_model(spark: SparkSession, root: str) -> models.Scorer:
    """The model of the latest run in the ledger."""
    ledger = spark.read.parquet(f"{root}/ledger").filter(F.col("scope") == "winner")
    run = store.newest_run(ledger).first()["run_ts"]
    return models.Scorer.load(spark, f"{root}/models/{run}")


def score_stage(batch: DataFrame, root: str, run_ts: str) -> DataFrame:
    """Score a batch with the newest model; store predictions and drift.

    The stored baselines are joined to the batch's profile (one row per
    feature or level). Returns the features that drifted.
    """
    spark = batch.sparkSession
    scorer = newest_model(spark, root)
    store.write_run(scorer.score(batch), f"{root}/predictions", run_ts)
    inputs = drop_non_features(batch)
    stored = lambda name: store.newest_run(store.read_runs(spark, f"{root}/{name}")).drop("run_ts")
    numeric = profile.numeric_drift(stored("baseline_numeric"), profile.numeric_baseline(inputs))
    categorical = profile.categorical_drift(stored("baseline_categorical"), profile.categorical_baseline(inputs), inputs.columns)
    store.write_run(numeric, f"{root}/drift_numeric", run_ts)
    store.write_run(categorical, f"{root}/drift_categorical", run_ts)
    store.write_run(profile.drift_summary(numeric, categorical, scorer.shape.feature_names, inputs.columns),
                    f"{root}/drift_summary", run_ts)
    return profile.flagged_features(numeric, categorical)


def latest_predictions(spark: SparkSession, root: str) -> DataFrame:
    return store.newest_run(store.read_runs(spark, f"{root}/predictions")).drop("run_ts")


def upload_predictions(spark: SparkSession, root: str, name: str = "churn_predictions") -> int:
    """Publish the newest predictions as a catalog table."""
    return store.load_table(latest_predictions(spark, root), name)


def gate_stage(spark: SparkSession, root: str, minimum: float = publish.MIN_ROC_AUC) -> DataFrame:
    """Verdict on the newest winner; a pass is recorded as a promotion."""
    ledger = store.newest_run(spark.read.parquet(f"{root}/ledger").filter(F.col("scope") == "winner"))
    one = ledger.groupBy("run_ts").agg(
        F.max(F.when(F.col("key") == "model_name", F.col("text"))).alias("model"),
        F.max(F.when(F.col("key") == "roc_auc", F.col("number"))).alias("roc_auc")).withColumn("deployed", F.lit(True))
    verdict = publish.model_gate(one, minimum)
    row = verdict.first()
    if row["passed"]:
        store.promote(spark, f"{root}/promotions", one.first()["run_ts"], row["model"], row["roc_auc"])
    return verdict


def segment_stage(features: DataFrame, ks=cluster.K_RANGE, restarts: int = cluster.RESTARTS,
                  resamples: int = cluster.RESAMPLES) -> dict[str, DataFrame]:
    """Sweep, choose k, fit, check stability, profile and name segments."""
    matrix = segments.cluster_matrix(features, [ID])
    points = for_iteration(cluster.standardised(matrix, [ID]))
    scores = cluster.sweep_k(points, ks, restarts)
    k = metrics.choose_k(scores).first()["k"]
    fit = cluster.fit_kmeans(points, k, restarts)
    labels = fit.assign(points, segments.CLUSTER_INPUTS).select(ID, "segment").persist()
    labelled = features.join(labels, ID)
    prof = segments.segment_profile(labelled)
    names = segments.name_segments(prof).select("segment", "name")
    differences = segments.differences_map(segments.segment_differences(matrix.join(labels, ID)))
    stable = cluster.stability(cluster.second_opinion(points, labels, k, ID),
                               cluster.resample_agreement(points, fit, ID, resamples))
    assignments = labels.join(F.broadcast(names.withColumnRenamed("name", "segment_name")), "segment")   # k names
    return {"assignments": assignments, "dim_segment": publish.segment_dimension(prof, names, differences),
            "fct_k_selection": scores, "stability": stable}


def explain_stage(batch: DataFrame, root: str, run_ts: str) -> DataFrame:
    """Explain a batch by the newest stored model, whatever its kind; stores the long and the global table."""
    explained = explain.explain(newest_model(batch.sparkSession, root), batch).persist()
    store.write_run(contributions.long_contributions(explained), f"{root}/contributions", run_ts)
    store.write_run(contributions.global_importance(explained), f"{root}/importance", run_ts)
    explained.unpersist()
    return store.newest_run(store.read_runs(batch.sparkSession, f"{root}/contributions")).drop("run_ts")


def design_stage(scored: DataFrame, root: str, experiment: str, threshold: float, mde: float = power.DEFAULT_MDE) -> DataFrame:
    """Register the design of an experiment on the targeted customers, before any outcome."""
    targeted = target_population(scored, threshold)
    design = power.design_table(power.design_inputs(targeted), mde).withColumn("experiment", F.lit(experiment))
    power.register_design(design, f"{root}/designs")
    return design


def experiment_stage(scored: DataFrame, root: str, run_ts: str, experiment: str, threshold: float, first_outcome, seed=42) -> dict[str, DataFrame]:
    """Assign, read both arms out with an A/A control, and judge by the design registered before ``first_outcome``.

    Without such a design there is no verdict. Stores the experiment and power reports.
    """
    spark = scored.sparkSession
    observed = ex.with_outcomes(ex.assign_arms(scored, threshold, seed), F.col(TARGET)).persist()

    def readout(frame, run):
        arms = ex.arms_wide(frame, ["retained", "revenue_net"])
        z = ex.two_proportion_z(arms.filter("metric = 'retained'"))
        return z, publish.experiment_fact(z, ex.welch_t(arms.filter("metric = 'revenue_net'")), run)

    z, main = readout(observed, "A/B test")
    facts = main.unionByName(readout(ex.same_arm_halves(observed, seed + 1), "A/A control")[1]).persist()
    reports.write_report(reports.report("experiment", {"readout": reports.section(facts, ["run", "metric"])}), f"{root}/reports", run_ts)
    start = spark.createDataFrame([(experiment, first_outcome)], "experiment string, first_outcome timestamp")
    stored = power.designs_as_of(spark.read.parquet(f"{root}/designs"), start).filter("registered_at is not null")
    judged = publish.power_fact(power.verdict(z.join(stored)), experiment)          # single rows
    reports.write_report(reports.report("power", {"designs": reports.section(judged, ["experiment"])}), f"{root}/reports", run_ts)
    return {"fct_ab_test": facts, "fct_power": judged}


def interpret_stage(features: DataFrame, root: str, run_ts: str) -> DataFrame:
    """Odds ratios of the reference-coded design; stores the coefficient report."""
    nominal, ordinal, numeric = active_groups(features.columns)
    rows = for_iteration(features)
    table = interpret.wald_table(rows, reference_design(rows, nominal, ordinal, numeric), TARGET).persist()
    reports.write_report(reports.report("coefficients", {"terms": reports.section(table, ["feature"])}), f"{root}/reports", run_ts)
    rows.unpersist()
    return table


def causal_stage(features: DataFrame, root: str, run_ts: str, draws: int = causal.BOOTSTRAP_DRAWS, runs: int = causal.PLACEBO_RUNS, seed=42) -> dict[str, DataFrame]:
    """The observational readout with its refuters; stores the causal report."""
    units = causal.prepare_observational(features).persist()
    out = run_observational(units, ID, draws=draws, seed=seed)
    effect = out["estimates"].filter("estimator = 'matching_att'").first()["estimate"]
    refuted = refute(units, ID, effect, runs, seed)
    single = lambda df: reports.section(df.withColumn("key", F.lit("all")), ["key"])
    reports.write_report(reports.report("causal", {
        "estimates": reports.section(out["estimates"], ["estimator"]), "balance": reports.section(out["balance"], ["covariate"]),
        "overlap": single(out["overlap"]), "matching": single(out["matching"]), "diagnostics": single(out["diagnostics"]),
        "refuters": reports.section(refuted, ["refuter"])}), f"{root}/reports", run_ts)
    units.unpersist()
    return {**out, "refuters": refuted}


def extract_stage(spark: SparkSession, root: str, path: str, kinds=("experiment", "power", "causal", "coefficients")) -> DataFrame:
    """Newest predictions, contributions and reports as CSV beside the dictionary."""
    newest = lambda name: store.newest_run(store.read_runs(spark, f"{root}/{name}")).drop("run_ts")
    flat = [reports.flatten(reports.newest_report(spark, f"{root}/reports", kind), ("report", "run_ts")) for kind in kinds]
    tables = {"predictions": newest("predictions"), "contributions": newest("contributions"), "importance": newest("importance"),
              "fct_reports": reduce(DataFrame.unionByName, flat),
              "fct_model_comparison": store.metric_table(spark.read.parquet(f"{root}/ledger"))}
    return export_stage(tables, path)


def export_stage(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Write every extract as CSV beside the data dictionary."""
    for name, df in tables.items():
        store.write_csv(df, f"{path}/{name}")
    dictionary = publish.data_dictionary(tables)
    store.write_csv(dictionary, f"{path}/data_dictionary")
    return dictionary
