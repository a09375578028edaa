"""Fits that share their passes, and selection without moving rows, against plain versions."""
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell import session
from keepwell.operators import cluster, encode, lloyd, metrics, ranking
from keepwell.session import for_iteration
from keepwell.sources import customers


def point_rows(spark, n=400, samples=3, seed=0, dimensions=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dimensions)) + 3 * rng.integers(0, 3, n)[:, None]
    w = (rng.random((n, samples)) < 0.7).astype(int)
    df = spark.createDataFrame([(list(map(float, a)), int(h), list(map(int, b))) for a, h, b in zip(x, rng.integers(-2 ** 62, 2 ** 62, n), w)],
                               "x array<double>, h long, w array<int>")
    return df.repartition(4), x, w


def plain_lloyd(x, centres, steps=300):
    for _ in range(steps):
        near = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        new = np.array([x[near == c].mean(0) if (near == c).any() else centres[c] for c in range(len(centres))])
        if np.abs(new - centres).max() <= lloyd.STILL:
            break
        centres = new
    return centres, ((x[:, None] - centres[None]) ** 2).sum(-1).min(1).sum()


def test_models_equal_plain_lloyd(spark):
    df, x, w = point_rows(spark)
    models = [lloyd.Model(k, s, r) for k in (2, 4) for s in (0, 1) for r in (None, 0, 2)]
    first = lloyd._seeded(df, models, 3, 7)
    assert np.array_equal(first[0, None][:2], lloyd._seeded(df.repartition(1), [lloyd.Model(2, 0)], 3, 7)[0, None])
    for fit in lloyd.fit_models(df, models, 3, 7):
        m = fit.model
        own = x if m.sample is None else x[w[:, m.sample] == 1]
        start = first[m.start, m.sample][:m.k]
        assert all((np.abs(own - c).sum(axis=1) < 1e-12).any() for c in start) and len(np.unique(start, axis=0)) == m.k
        centres, cost = plain_lloyd(own, start)
        assert fit.converged and fit.centres == pytest.approx(centres, abs=1e-8) and fit.cost == pytest.approx(cost)


def test_next_centres_are_drawn_by_squared_distance(spark):
    """Two points at distances 1 and 3 from the first centre: the far one is drawn nine times in ten."""
    rows = [([0.0], 1, [1]), ([1.0], 22, [1]), ([-3.0], 333, [1])]
    df = spark.createDataFrame(rows, "x array<double>, h long, w array<int>")
    sequences = [(s, None) for s in range(2000)]
    won = lloyd._winners(df, sequences, np.zeros((2000, 2, 1)), 1, 5)
    share = np.mean([w[0] == -3.0 for w in won.values()])
    assert abs(share - 0.9) < 0.03 and {w[0] for w in won.values()} == {1.0, -3.0}


def test_fewer_points_than_clusters(spark):
    df = spark.createDataFrame([([1.0], 5, [1]), ([1.0], 5, [1]), ([2.0], 6, [1])], "x array<double>, h long, w array<int>")
    fit = lloyd.best_of(lloyd.fit_models(df, [lloyd.Model(4, 0)], 1))
    assert fit.cost == 0.0 and {float(c[0]) for c in fit.centres} == {1.0, 2.0}
    assert lloyd.fit_models(df.limit(0), [lloyd.Model(2, 0)], 1)[0].cost == 0.0


def test_agreement_equals_the_column_form(spark):
    df, x, w = point_rows(spark, seed=3)
    own, other = lloyd.fit_models(df, [lloyd.Model(3, 0), lloyd.Model(3, 1, 1)], 3)
    named = df.filter("w[1] = 1").select(*[F.col("x")[i].alias(c) for i, c in enumerate("abc")])
    both = other.assign(own.assign(named, "abc", "one"), "abc", "two")
    assert lloyd.agreement(df, own, [other])[0] == pytest.approx(metrics.adjusted_rand(both, "one", "two").first()[0])


def test_dear_rows_are_spread_over_the_cores(spark, monkeypatch):
    points = spark.range(16000).selectExpr("cast(id as string) as k", *[f"cast(id % {n} as double) as {c}" for n, c in ((7, "a"), (11, "b"), (13, "c"))])
    seen, fit = [], lloyd.fit_models
    monkeypatch.setattr(lloyd, "fit_models", lambda rows, models, *rest: seen.append(rows.rdd.getNumPartitions()) or fit(rows, models[:2], *rest))
    monkeypatch.setattr(lloyd, "best_of", lambda fits: None)
    cores = spark.sparkContext.defaultParallelism
    cluster.sweep_models(points, restarts=20, inputs=list("abc"))
    assert seen == [cores]
    assert for_iteration(points).rdd.getNumPartitions() == 1          # cheap rows stay together
    assert for_iteration(points, work=20).rdd.getNumPartitions() == min(cores, 2)


def test_a_step_equals_plain_sums(spark):
    df, x, w = point_rows(spark, seed=5)
    models = [lloyd.Model(2, 0), lloyd.Model(3, 0, 1), lloyd.Model(3, 1, 0), lloyd.Model(3, 2)]
    centres = {m: x[i:i + m.k] + 0.01 for i, m in enumerate(models)}
    for m, row in zip(models, lloyd._step(df, models, centres, 3)):
        d = ((x[:, None, :] - centres[m][None]) ** 2).sum(axis=2)
        near, own = d.argmin(axis=1), np.ones(len(x)) if m.sample is None else w[:, m.sample]
        assert row[0] == pytest.approx((d.min(axis=1) * own).sum())
        assert row[1:1 + m.k] == pytest.approx([own[near == j].sum() for j in range(m.k)])
        assert row[4:4 + 3 * m.k] == pytest.approx(np.concatenate([(x * own[:, None])[near == j].sum(axis=0) for j in range(m.k)]))


def test_fixed_point_sees_motion(spark):
    df, x, _ = point_rows(spark, seed=4)
    named = df.select(*[F.col("x")[i].alias(c) for i, c in enumerate("abc")])
    fit = lloyd.fit_models(df, [lloyd.Model(3, 0)], 3)[0]
    assert tuple(lloyd.fixed_point(named, fit, "abc").first()) == (3, 0, 0.0)
    moved = lloyd.Fitted(fit.model, fit.centres + 0.5, fit.cost, False)
    assert lloyd.fixed_point(named, moved, "abc").first()["centre_gap"] > 0.1


# --- selection

def test_cuts_equal_ranks(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 10 > 0, F.col("id") % 3).alias("s")).repartition(5)
    wanted = lambda n: [n // 3, 1, 0, n, n - 1]
    hashes = [ranking.seeded_hash("k", 1), ranking.seeded_hash("k", 2)]
    cuts = ranking.hash_cuts(df, hashes, wanted, ["s"])
    for i, seed in ((0, 1), (1, 2)):
        ranked = ranking.hash_rank(df, "k", seed, ["s"])
        for slot in range(5):
            m = [F.floor(F.col("stratum_size") / 3), F.lit(1), F.lit(0), F.col("stratum_size"), F.col("stratum_size") - 1][slot]
            wrong = ranked.filter((F.col("hash_rank") <= m) != cuts.below(ranking.seeded_hash("k", seed), i, slot)).count()
            assert wrong == 0, (seed, slot)


def test_split_flags_rows_where_they_lie(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("customerID"), (F.col("id") % 4 == 0).cast("int").alias("Churn"))
    out = encode.stratified_split(df, "customerID", 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    counts = {(r["Churn"], r["split"]): r["count"] for r in out.groupBy("Churn", "split").count().collect()}
    assert counts == {(0, "test"): 150, (0, "validation"): 150, (0, "train"): 450, (1, "test"): 50, (1, "validation"): 50, (1, "train"): 150}


def test_repeated_keys_are_still_counted_exactly(spark):
    df = spark.createDataFrame([("same", 1)] * 10 + [(None, 0)] * 10, "customerID string, Churn int")
    with pytest.raises(ranking.SharedHash):
        ranking.hash_cuts(df, [ranking.seeded_hash("customerID", 1)], lambda n: [n // 2], ["Churn"])
    counts = {(r["Churn"], r["split"]): r["count"] for r in encode.stratified_split(df, "customerID", 1, test=Fraction(1, 2), validation=Fraction(0)).groupBy("Churn", "split").count().collect()}
    assert counts == {(0, "test"): 5, (0, "train"): 5, (1, "test"): 5, (1, "train"): 5}


def test_cuts_of_nothing(spark):
    df = spark.createDataFrame([], "k string")
    cuts = ranking.hash_cuts(df, [ranking.seeded_hash("k", 1)], lambda n: [math.floor(n / 2)])
    assert df.filter(cuts.below(ranking.seeded_hash("k", 1))).count() == 0


def test_running_totals_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(ranking, "GROUP", 3)
    rng = np.random.default_rng(6)
    v = np.r_[rng.integers(0, 90, 500), np.full(200, 7)]
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(v, rng.integers(0, 5, len(v)))], "v int, n int").repartition(4)
    for size in (4, 10 ** 6):
        got = {r["v"]: (r["n"], r["n_below"]) for r in ranking.cumulative_by_value(df, "v", {"n": F.col("n")}, slab_values=size).collect()}
        rows = df.collect()
        assert got == {k: (sum(r.n for r in rows if r.v == k), sum(r.n for r in rows if r.v < k)) for k in set(v.tolist())}


def test_more_partitions_than_cores_only_for_very_many_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    parts = lambda rows: for_iteration(spark.range(10), rows).rdd.getNumPartitions()
    assert parts(session.ROWS_PER_TASK * 3 * cores) == cores
    assert parts(session.MOST_ROWS_PER_TASK * 3 * cores) == 3 * cores


def test_a_step_deals_ties_to_the_smaller_number_and_leaves_out_other_samples(spark):
    df, x, w = point_rows(spark, n=50, samples=2)
    models = [lloyd.Model(3, 0, 1), lloyd.Model(2, 0)]
    centres = {models[0]: np.array([x[0], x[0], x[1]]), models[1]: np.array([x[2], x[2]])}
    got = lloyd._step(df, models, centres, 3)
    first = ((x - x[0]) ** 2).sum(1) <= ((x - x[1]) ** 2).sum(1)
    chosen = w[:, 1] == 1
    assert got[0, 1:4].tolist() == [(first & chosen).sum(), 0, (~first & chosen).sum()]
    assert got[1, 1:3].tolist() == [50, 0]
    assert np.allclose(got[0, 0], np.minimum(((x - x[0]) ** 2).sum(1), ((x - x[1]) ** 2).sum(1))[chosen].sum())


def test_running_totals_send_slab_totals_only(spark):
    df = spark.createDataFrame([(float(v), 1) for v in range(40)], "v double, n long")
    plan = ranking.cumulative_by_value(df, "v", {"n": F.col("n")}, slab_values=10)._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan


def test_customers_meet_their_orders_without_a_broadcast(spark, tmp_path):
    spark.sql("select id as c_custkey, 'n' as c_name, cast(id % 5 as int) as c_nationkey, 10.5D as c_acctbal, 'MACHINERY' as c_mktsegment "
              "from range(20)").write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("select id as o_orderkey, id % 15 as o_custkey, 'O' as o_orderstatus, 1.0D as o_totalprice, "
              "timestamp_ntz'2001-02-03 00:00:00' as o_orderdate, 'x' as o_orderpriority from range(60)").write.parquet(f"{tmp_path}/orders.parquet")
    frame = customers.customer_frame(spark, str(tmp_path))
    assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["customerID"] for r in frame.collect()) == [f"C-{i:09d}" for i in range(15)]
