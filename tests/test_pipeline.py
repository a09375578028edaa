import os
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.plans import pipeline, reports
from keepwell.schema import CANONICAL_COLUMNS, RAW_COLUMNS, RAW_SCHEMA
from keepwell.session import scratch_folder
from conftest import RAW


@pytest.fixture(scope="module")
def many(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(360):
        row = {c: v[rng.integers(len(v))] for c, v in RAW.items()}
        tenure, price = int(rng.integers(0, 60)), float(np.round(rng.uniform(20, 110), 2))
        risk = 1 / (1 + np.exp(0.08 * tenure - 0.02 * price - (row["Contract"] == "Month-to-month")))
        row.update(customerID=f"C{i:04d}", SeniorCitizen=int(i % 5 == 0), tenure=tenure, MonthlyCharges=price,
                   TotalCharges=" " if tenure == 0 else str(round(tenure * price, 2)), Churn="Yes" if rng.random() < risk else "No")
        rows.append(tuple(row[c] for c in RAW_COLUMNS))
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_from_raw_to_gate(spark, many):
    pipeline.feature_stage(many, "t_")
    features = pipeline.feature_stage(many, "t_")              # a second run replaces the first
    assert features.columns == CANONICAL_COLUMNS and features.count() == 360
    assert features.filter("TotalCharges is null").isEmpty()
    assert pipeline.segment_report(spark, "t_", 3).count() <= 3

    root = scratch_folder(spark, "runs")
    scorer = pipeline.train_stage(features, root, "20260101-000000", tree_params={"maxIter": 3, "maxDepth": 2}, trials=2)
    assert pipeline.newest_model(spark, root).name == scorer.name
    batch = spark.read.parquet(f"{root}/scoring_batch").drop("run_ts")
    assert batch.count() < 100
    pipeline.score_stage(batch, root, "20260102-000000")
    drifted = batch.withColumns({"MonthlyCharges": F.col("MonthlyCharges") * 1.25, "Contract": F.lit("Month-to-month")})
    flagged = {r["feature"] for r in pipeline.score_stage(drifted, root, "20260103-000000").collect()}
    assert {"MonthlyCharges", "Contract"} <= flagged
    latest = pipeline.latest_predictions(spark, root)
    assert latest.count() == batch.count() and latest.filter("churn_probability not between 0 and 1").isEmpty()
    assert pipeline.upload_predictions(spark, root, "t_predictions") == batch.count()
    assert not pipeline.gate_stage(spark, root, 1.01).first()["passed"]
    assert pipeline.gate_stage(spark, root, 0.5).first()["passed"]
    assert spark.read.parquet(f"{root}/promotions").count() == 1
    ledger = spark.read.parquet(f"{root}/ledger")
    assert ledger.filter("scope like 'metrics/%'").select("scope").distinct().count() == 4
    assert ledger.filter("scope like 'trials/%' and key = 'roc_auc'").count() == 2 and ledger.filter("scope = 'params/boosted_trees_tuned'").count() > 4


def test_experiment_to_extract(spark, many, tmp_path):
    features = pipeline.feature_stage(many, "e_")
    root = scratch_folder(spark, "runs")
    pipeline.train_stage(features, root, "20260101-000000", tree_params={"maxIter": 1, "maxDepth": 1}, trials=1)
    batch = spark.read.parquet(f"{root}/scoring_batch").drop("run_ts")
    pipeline.score_stage(batch, root, "20260102-000000")
    long = pipeline.explain_stage(batch, root, "20260102-000000")
    assert long.select("customerID").distinct().count() == batch.count()
    scored = pipeline.newest_model(spark, root).score(features)
    pipeline.design_stage(scored, root, "offer", 0.3)
    out = pipeline.experiment_stage(scored, root, "20260103-000000", "offer", 0.3, datetime(2100, 1, 1))
    assert out["fct_ab_test"].count() == 4 and out["fct_power"].first()["verdict"] in ("significant", "null", "inconclusive")
    pipeline.extract_stage(spark, root, str(tmp_path), kinds=("experiment", "power"))
    facts = spark.read.csv(f"{tmp_path}/fct_reports", header=True)
    assert {r["report"] for r in facts.select("report").distinct().collect()} == {"experiment", "power"}
    assert {r["run_ts"] for r in facts.select("run_ts").distinct().collect()} == {"20260103-000000"}


@pytest.mark.skipif(not os.environ.get("SLOW_TESTS"), reason="minutes; set SLOW_TESTS")
def test_causal_and_coefficient_reports(spark, many):
    features = pipeline.feature_stage(many, "c_")
    root = scratch_folder(spark, "runs")
    assert pipeline.interpret_stage(features, root, "20260105-000000").count() > 10
    pipeline.causal_stage(features, root, "20260105-000000", draws=0, runs=1)
    flat = reports.flatten(reports.newest_report(spark, f"{root}/reports", "causal"), ("report", "run_ts"))
    assert not flat.filter("path = 'estimates.ipw_ate.estimate'").isEmpty()


def test_segments_and_export(spark, many, tmp_path):
    features = pipeline.feature_stage(many, "s_")
    out = pipeline.segment_stage(features, ks=range(2, 4), restarts=1, resamples=2)
    assert out["assignments"].count() == 360 and out["assignments"].filter("segment_name is null").isEmpty()
    assert out["stability"].first()["bootstrap_iterations"] == 2
    dictionary = pipeline.export_stage({"dim_segment": out["dim_segment"], "fct_k_selection": out["fct_k_selection"]}, str(tmp_path))
    assert dictionary.select("table_name").distinct().count() == 2
    assert spark.read.csv(f"{tmp_path}/dim_segment", header=True).count() == out["dim_segment"].count()
