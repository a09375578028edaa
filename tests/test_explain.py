"""Explanations of stored models, the report walker and designs as of their experiment."""
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.operators import explain, models, power
from keepwell.plans import reports
from keepwell.session import scratch_folder


@pytest.fixture(scope="module")
def customers(spark):
    rng = np.random.default_rng(3)
    rows = [(f"c{i:03d}", str(rng.choice(["DSL", "Fiber optic", "No"])), str(rng.choice(["Month-to-month", "One year", "Two year"])),
             int(rng.integers(0, 60)), float(rng.uniform(20, 110)), int(rng.random() < 0.4)) for i in range(300)]
    return spark.createDataFrame(rows, "customerID string, InternetService string, Contract string, tenure int, MonthlyCharges double, Churn int").cache()


@pytest.mark.parametrize("kind", ["linear", "trees"])
def test_contributions_add_up_to_the_stored_margin(spark, customers, kind):
    fitted = models.fit_linear(customers) if kind == "linear" else models.fit_trees(customers, customers, "t", maxIter=4, maxDepth=3)
    path = scratch_folder(spark, "stored")
    fitted.save(path)
    scorer = models.Scorer.load(spark, path)
    strange = customers.withColumn("InternetService", F.when(F.col("tenure") % 7 == 0, "Satellite").otherwise(F.col("InternetService")))
    gaps = explain.additivity(explain.explain(scorer, strange), explain.margins(scorer, strange))
    assert gaps.count() == 300 and gaps.agg(F.max(F.abs("gap"))).first()[0] < 1e-9


def test_linear_means_are_a_parameter(spark, customers):
    scorer = models.fit_linear(customers)
    linear = explain.resolve_linear(scorer.pipeline)
    assert set(linear.terms) == {"InternetService_DSL", "InternetService_Fiber optic", "InternetService_No", "Contract_code", "tenure", "MonthlyCharges"}
    out = explain.explain(scorer, customers, dict.fromkeys(linear.terms, 0.0)).first()
    assert out["base_value"] == pytest.approx(linear.intercept)


def test_other_stages_are_refused(spark, customers):
    scorer = models.fit_trees(customers, customers, "t", maxIter=1, maxDepth=1)
    with pytest.raises(ValueError):
        explain.resolve_linear(scorer.pipeline)


def test_walker_unfolds_any_nesting(spark):
    doc = spark.sql("""select 'r' as report, map('a', named_struct('x', 1, 'y', array(named_struct('z', 2.5D), named_struct('z', null)))) as m,
                       array(map('k', true), map('k', false)) as l, cast(null as struct<q:int>) as gone, 'word' as w, cast(array() as array<int>) as e""")
    rows = {r["path"]: (r["number"], r["text"]) for r in reports.flatten(doc).collect()}
    assert rows == {"m.a.x": (1.0, None), "m.a.y.0.z": (2.5, None), "m.a.y.1.z": (None, None), "l.0.k": (1.0, None), "l.1.k": (0.0, None), "w": (None, "word")}


def test_report_round_trip_keeps_paths(spark):
    rows = spark.createDataFrame([("a", "x", 1.5, True), ("b", "y", None, False)], "k string, l string, v double, ok boolean")
    root = scratch_folder(spark, "reports")
    for run, factor in (("20260101-000000", 1), ("20260102-000000", 2)):
        one = reports.report("kind", {"part": reports.section(rows.withColumn("v", F.col("v") * factor), ["k", "l"])})
        schema = reports.write_report(one, root, run)
    given = {r["path"]: r["number"] for r in reports.flatten(reports.read_report(spark, root, "kind", "20260101-000000", schema)).collect()}
    assert given == {"part.a|x.v": 1.5, "part.a|x.ok": 1.0, "part.b|y.v": None, "part.b|y.ok": 0.0}
    newest = {r["path"]: r["number"] for r in reports.flatten(reports.newest_report(spark, root, "kind"), ("report", "run_ts")).collect()}
    assert newest["part.a|x.v"] == 3.0


def test_late_designs_are_refused(spark):
    at = lambda day: datetime(2026, 1, day)
    designs = spark.createDataFrame([("a", at(1), 10), ("a", at(5), 20), ("a", at(9), 30), ("b", at(9), 40)], "experiment string, registered_at timestamp, n int")
    starts = spark.createDataFrame([("a", at(6)), ("b", at(6)), ("c", at(6))], "experiment string, first_outcome timestamp")
    rows = {r["experiment"]: (r["n"], r["refused"]) for r in power.designs_as_of(designs, starts).collect()}
    assert rows == {"a": (20, 1), "b": (None, 1), "c": (None, 0)}
    same = spark.createDataFrame([("a", at(5))], "experiment string, first_outcome timestamp")
    assert power.designs_as_of(designs, same).first()["n"] == 10          # registered at the very moment is too late
