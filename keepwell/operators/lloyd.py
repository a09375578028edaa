"""Many k-means models over the same points, one pass over the data per step.

A model is a number of clusters, a start and a sample of the points (a weight
column of 0 and 1). All models are seeded and updated together: a pass multiplies
each Arrow batch with the centres of every open model at once and adds counts,
sums and costs per model; sums are added up by model, and the new centres
(models x k x dimensions numbers) go back with the next pass.

Starts are k-means++ draws: in each round every start picks the next centre with a
probability in proportion to the squared distance, as the winner of an
exponential race whose random numbers are hashes of row, start and round. So a
draw depends on neither partitioning nor order, and models of different k share
their first centres. Equal rows of equal hash race as one.

A model ends when no centre moves; a cluster that runs empty keeps its centre.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from keepwell.operators.newton import blocks, matrix, summed

MOST_STEPS = 300
STILL = 1e-9
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


@dataclass(frozen=True)
class Model:
    """What is fitted: clusters, the start, and the sample (an index into ``w``, None for all points)."""

    k: int
    start: int
    sample: int | None = None


@dataclass
class Fitted:
    """Centres and cost of a model. ``converged`` is false if it still moved after MOST_STEPS."""

    model: Model
    centres: np.ndarray
    cost: float
    converged: bool

    def label(self, inputs: Sequence[str]) -> Column:
        """Number of the nearest centre; ties go to the smaller number."""
        far = self.distances(inputs)
        return (F.array_position(far, F.array_min(far)) - 1).cast("int")

    def distances(self, inputs: Sequence[str]) -> Column:
        """Squared distances to the centres, as one SQL text: a call per term takes seconds."""
        gap = lambda c, v: f"(`{c}` - {float(v)!r}D) * (`{c}` - {float(v)!r}D)"
        return F.expr("array(" + ", ".join(" + ".join(["0.0D", *map(gap, inputs, centre)]) for centre in self.centres) + ")")

    def assign(self, points: DataFrame, inputs: Sequence[str], name: str = "segment") -> DataFrame:
        return points.withColumn(name, self.label(inputs))


def _uniform(rows: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) for every row hash and salt."""
    with np.errstate(over="ignore"):
        z = rows[:, None] ^ salts[None, :]
        for shift, factor in ((30, _MIX[0]), (27, _MIX[1])):
            z = (z ^ (z >> np.uint64(shift))) * factor
        z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype(float) + 0.5) / 2.0 ** 53


def _salt(*parts: int) -> np.uint64:
    value = 0x9E3779B97F4A7C15
    for p in parts:
        value = ((value ^ (p + 0x7F4A7C15)) * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) % (1 << 64)
    return np.uint64(value)


def _weights(part: pa.RecordBatch, samples: Sequence[int | None]) -> np.ndarray | None:
    """0 or 1 per row and model; None if every model takes all points."""
    if all(s is None for s in samples):
        return None
    w = np.column_stack([np.ones(part.num_rows), matrix(part.column("w"), part.num_rows)])
    return w[:, [0 if s is None else s + 1 for s in samples]]


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Rows x centres."""
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)[None, :], 0.0)


def _winners(rows: DataFrame, sequences: list[tuple[int, int | None]], chosen: np.ndarray, turn: int, seed: int) -> dict[int, list[float]]:
    """The next centre of every start."""
    salts = np.array([_salt(seed, turn, start, -1 if s is None else s) for start, s in sequences])
    samples = [s for _, s in sequences]
    width = len(sequences)

    def race(batches):
        best, where = np.full(width, np.inf), [None] * width
        for part, x in blocks(batches, width * max(turn, 1)):
            hashes = part.column("h").to_numpy().view(np.uint64)
            pull = np.ones((len(x), width))
            if turn:
                d = _squared(x, chosen[:, :turn].reshape(width * turn, -1)).reshape(len(x), width, turn)
                pull = d.min(axis=2)
            w = _weights(part, samples)
            pull = pull if w is None else pull * w
            with np.errstate(divide="ignore"):
                time = np.where(pull > 0, -np.log(_uniform(hashes, salts)) / pull, np.inf)
            first = time.argmin(axis=0)
            for m in np.flatnonzero(time[first, np.arange(width)] < best):
                best[m], where[m] = time[first[m], m], x[first[m]].tolist()
        won = [m for m in range(width) if where[m] is not None]
        if won:
            yield pa.RecordBatch.from_arrays([pa.array(won, pa.int32()), pa.array(best[won]), pa.array([where[m] for m in won], pa.list_(pa.float64()))],
                                             names=["start", "time", "x"])

    return {r["start"]: list(r["x"]) for r in rows.mapInArrow(race, "start int, time double, x array<double>")
            .groupBy("start").agg(F.min_by("x", F.struct("time", "x")).alias("x")).collect()}            # one row per start


def _seeded(rows: DataFrame, models: Sequence[Model], dimensions: int, seed: int) -> dict[tuple[int, int | None], np.ndarray]:
    """First centres: per start and sample as many as its largest model has."""
    sequences = sorted({(m.start, m.sample) for m in models}, key=lambda s: (-1 if s[1] is None else s[1], s[0]))
    most = max(m.k for m in models)
    chosen = np.zeros((len(sequences), most, dimensions))
    for turn in range(most):
        won = _winners(rows, sequences, chosen, turn, seed)
        for i in range(len(sequences)):
            # all points of the sample are centres already: repeat one
            chosen[i, turn] = won[i] if i in won else chosen[i, turn - 1] if turn else 0.0
    return dict(zip(sequences, chosen))


def _step(rows: DataFrame, models: Sequence[Model], centres: dict[Model, np.ndarray], dimensions: int) -> np.ndarray:
    """Per model: cost, then count and sums of each cluster, padded to the largest k.

    Distances lie cluster by cluster, a row of all models each, so that the nearest
    centre is found by whole-row comparisons without branches; ties go to the smaller
    number. The norm of a point is the same for all centres and is added to the least
    distance only; points outside the sample of a model are dealt to no cluster.
    """
    groups = []
    for k in sorted({m.k for m in models}):
        own = [i for i, m in enumerate(models) if m.k == k]
        c = np.stack([centres[models[i]] for i in own], axis=1).reshape(k * len(own), dimensions)
        groups.append((k, own, np.column_stack([-2 * c, (c * c).sum(axis=1)]), [models[i].sample for i in own]))
    most = max(k for k, *_ in groups)
    total = sum(len(c) for _, _, c, _ in groups)

    def values(part, x):
        out = np.zeros((len(models), 1 + most * (1 + dimensions)))
        norm, ones = (x * x).sum(axis=1), np.column_stack([np.ones(len(x)), x])
        lifted = np.vstack([x.T, np.ones(len(x))])
        for k, own, c, samples in groups:
            d = (c @ lifted).reshape(k, len(own), len(x))
            least = d.min(axis=0)
            w = _weights(part, samples)
            w = None if w is None else np.ascontiguousarray(w.T)
            dealt = np.zeros(least.shape, bool) if w is None else w == 0
            for j in range(k):
                mine = (d[j] == least) & ~dealt
                dealt |= mine
                d[j] = mine
            least += norm
            np.maximum(least, 0.0, out=least)
            if w is not None:
                least *= w
            sums = (d.reshape(k * len(own), len(x)) @ ones).reshape(k, len(own), 1 + dimensions)
            out[own, 0] = least.sum(axis=1)
            out[own, 1:1 + k] = sums[:, :, 0].T
            out[own, 1 + most:1 + most + k * dimensions] = sums[:, :, 1:].transpose(1, 0, 2).reshape(len(own), k * dimensions)
        return out

    return summed(rows, total, values)


def fit_models(rows: DataFrame, models: Sequence[Model], dimensions: int, seed: int = 42) -> list[Fitted]:
    """All models at once. ``rows`` has x (array of the inputs), h (a row hash) and, with samples, w (0 or 1 per sample)."""
    models = list(models)
    first = _seeded(rows, models, dimensions, seed)
    centres = {m: first[m.start, m.sample][:m.k].copy() for m in models}
    cost = dict.fromkeys(models, np.inf)
    open_models, steps = models, 0
    while open_models:
        got = _step(rows, open_models, centres, dimensions)
        if not len(got):
            return [Fitted(m, centres[m], 0.0, True) for m in models]
        steps += 1
        most = max(m.k for m in open_models)
        going = []
        for m, row in zip(open_models, got):
            cost[m] = float(row[0])
            n = row[1:1 + m.k]
            sums = row[1 + most:1 + most + m.k * dimensions].reshape(m.k, dimensions)
            new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres[m])
            moved = np.abs(new - centres[m]).max() > STILL
            if moved and steps < MOST_STEPS:
                centres[m] = new
                going.append(m)
            elif moved:
                going.append(m)
        if steps >= MOST_STEPS:
            break
        open_models = going
    return [Fitted(m, centres[m], cost[m], m not in going) for m in models]


def best_of(fits: Sequence[Fitted]) -> Fitted:
    """Least cost; ties go to the earlier start."""
    return min(fits, key=lambda f: (round(f.cost, 9), f.model.start))


def agreement(rows: DataFrame, own: Fitted, others: Sequence[Fitted]) -> list[float]:
    """Adjusted Rand index of one labelling and each of the others, on the sample of the other."""
    samples = [f.model.sample for f in others]
    base, k = own.centres, max([len(own.centres), *(len(f.centres) for f in others)])

    def values(part, x):
        mine = _squared(x, base).argmin(axis=1)
        w = _weights(part, samples)
        out = np.zeros((len(others), k * k))
        for i, f in enumerate(others):
            cell = mine * k + _squared(x, f.centres).argmin(axis=1)
            out[i] = np.bincount(cell, None if w is None else w[:, i], k * k)
        return out

    tables = summed(rows, len(others) * k, values).reshape(-1, k, k)
    return [_rand(t) for t in tables]


def _rand(table: np.ndarray) -> float:
    pairs = lambda n: float((n * (n - 1) / 2).sum())
    both, rows, columns, every = pairs(table), pairs(table.sum(axis=1)), pairs(table.sum(axis=0)), pairs(np.array([table.sum()]))
    expected = rows * columns / every if every else 0.0
    best = (rows + columns) / 2
    return 1.0 if best == expected else (both - expected) / (best - expected)


def fixed_point(points: DataFrame, fit: Fitted, inputs: Sequence[str]) -> DataFrame:
    """(k, nearer_elsewhere, centre_gap) by plain column sums: both are 0 for a model that came to rest."""
    labelled = points.select(*inputs, fit.label(inputs).alias("label"), fit.distances(inputs).alias("far"))
    elsewhere = F.count_if(F.exists("far", lambda d: d < F.col("far")[F.col("label")] - 1e-9))
    means = labelled.groupBy("label").agg(elsewhere.alias("elsewhere"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(inputs)])
    own = F.array(*[F.array(*[F.lit(float(v)) for v in centre]) for centre in fit.centres])[F.col("label")]
    gap = F.greatest(*[F.abs(F.col(f"m{i}") - own[i]) for i in range(len(inputs))])
    return means.agg(F.sum("elsewhere").alias("nearer_elsewhere"), F.round(F.max(gap), 6).alias("centre_gap")).select(
        F.lit(fit.model.k).alias("k"), "nearer_elsewhere", "centre_gap")
