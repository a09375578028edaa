"""Rows that must not get lost: NULLs in terms, strata and features, rejected records."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.operators import profile, regression
from keepwell.operators.models import winner
from keepwell.operators.ranking import hash_rank
from keepwell.schema import RECORD_SCHEMA
from keepwell.session import scratch_folder
from keepwell.sources import store
from keepwell.streaming import scoring as online


@pytest.mark.parametrize("width", [2, 12])
def test_moments_leave_out_whole_rows(spark, width):
    x = np.random.RandomState(1).rand(60, width)
    rows = [tuple(map(float, r)) for r in x]
    gaps = [(None, *rows[0][1:]), (*rows[1][:-1], float("nan"))]
    df = spark.createDataFrame(rows + gaps, ", ".join(f"c{i} double" for i in range(width)))
    assert np.allclose(regression.moments(df, {f"c{i}": F.col(f"c{i}") for i in range(width)}), x.T @ x)


def test_infinite_moments_are_an_error(spark):
    df = spark.createDataFrame([(float("inf"),), (1.0,)], "c double")
    with pytest.raises(ValueError):
        regression.moments(df, {"c": F.col("c")})


def test_a_null_stratum_keeps_its_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "a"), (None, None)], "k long, s string")
    got = {(r.k, r.s): (r.hash_rank, r.stratum_size) for r in hash_rank(df, "k", 1, ["s"]).collect()}
    assert len(got) == 5 and {got[k, None][1] for k in (2, 3, None)} == {3} and {got[k, None][0] for k in (2, 3, None)} == {1, 2, 3}


def test_a_feature_that_lost_all_values_drifts(spark):
    a = spark.createDataFrame([("x", "u"), ("y", "u")], "c string, d string")
    b = spark.createDataFrame([(None, "u"), (None, "u")], "c string, d string")
    sides = [profile.categorical_baseline(x, ["c", "d"]) for x in (a, b)]
    got = {r.feature: r for r in profile.categorical_drift(*sides, b.columns).collect()}
    assert got["c"].drifted and got["c"].tvd == pytest.approx(0.5) and got["c"].missing_categories == ["x", "y"] and not got["d"].drifted
    assert {r.feature for r in profile.categorical_drift(*sides).collect()} == {"d"}


def test_parsing_leaves_the_record_schema_alone(spark):
    before = len(RECORD_SCHEMA)
    online.parse(spark.createDataFrame([("{}",)], "value string")).collect()
    assert len(RECORD_SCHEMA) == before


def test_rejected_records_are_written(spark):
    folder = scratch_folder(spark, "rejected")
    spark.createDataFrame([("{broken",), ('{"tenure": -1}',)], "value string").write.text(f"{folder}/in")
    records = online.parse(spark.readStream.schema("value string").text(f"{folder}/in"))
    online.run_stream(records, lambda d: d.withColumn("churn_probability", F.lit(0.5)), "v1", "m", f"{folder}/out", f"{folder}/state")
    got = spark.read.parquet(f"{folder}/out-rejected").collect()
    assert len(got) == 2 and any("malformed" in r.problems for r in got) and any("negative tenure" in r.problems for r in got)


def test_append_counts_what_it_wrote(spark):
    df = spark.range(5)
    assert store.load_table(df, "counted_rows") == 5
    assert store.load_table(spark.range(3), "counted_rows", "append") == 3 and spark.table("counted_rows").count() == 8


def test_equal_candidates_are_told_by_name(spark):
    table = spark.createDataFrame([("a", 0.5), ("b", 0.5), ("c", 0.1)], "model string, roc_auc double")
    assert [(r.model, r.deployed) for r in winner(table).collect()] == [("b", True), ("a", False), ("c", False)]
