"""Many logistic fits over the same rows, one pass over the data per Newton step.

All fits share their design and differ in the weights of the rows: bootstrap
replicates, arms, runs of a refuter. In a pass each Arrow batch adds the loss,
gradient and k x k information matrix of every fit that is still open; sums are
added up per fit, and the small systems are solved together on the driver. What
reaches the driver is k x k numbers per fit, whatever the rows.

A fit ends when its Newton decrement vanishes; steps that raise the loss are
halved. Fits without two outcome classes predict their rate; fits that don't
converge are marked, never returned as if they had.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rows of a block times fits that a task holds at once.
BLOCK_VALUES = 1 << 19
PASSES = 80
TOLERANCE = 1e-20

#: From a batch: successes and totals, a column per fit, and the weights whose spread scales the penalty.
Reader = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]


def matrix(column: pa.Array, rows: int) -> np.ndarray:
    """A list column of equal lengths as a matrix of doubles."""
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), float)
    return flat.reshape(rows, -1)


@dataclass
class Fits:
    """Raw-scale models, a row per fit. ``rate`` is set where a fit has one outcome class, NaN elsewhere."""

    names: list[str]
    intercept: np.ndarray
    weights: np.ndarray
    rate: np.ndarray
    converged: np.ndarray
    passes: int

    def linear(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights.T + self.intercept

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Rows x fits; NaN for a fit without rows or that did not converge."""
        p = 1.0 / (1.0 + np.exp(-np.clip(self.linear(x), -700, 700)))
        p = np.where(np.isnan(self.rate), p, self.rate)
        return np.where(self.converged, p, np.nan)


def blocks(batches: Iterator[pa.RecordBatch], fits: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of batches small enough for matrices of rows x fits, with their design."""
    size = max(64, BLOCK_VALUES // max(fits, 1))
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            yield part, matrix(part.column("x"), part.num_rows)


def summed(rows: DataFrame, fits: int, values: Callable[[pa.RecordBatch, np.ndarray], np.ndarray]) -> np.ndarray:
    """Fits x width: the sum over all rows of what ``values`` gives for a block; empty without rows."""
    def partial(batches):
        total = None
        for part, x in blocks(batches, fits):
            add = values(part, x)
            total = add if total is None else total + add
        if total is not None:
            yield _sums(np.arange(len(total)), total)

    def add_up(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, row in zip(batch.column("fit").to_pylist(), matrix(batch.column("sums"), batch.num_rows)):
                total[k] = total[k] + row if k in total else row
        if total:
            yield _sums(np.array(list(total)), np.array(list(total.values())))

    parts = rows.mapInArrow(partial, "fit int, sums array<double>").repartition("fit").mapInArrow(add_up, "fit int, sums array<double>")
    found = {r["fit"]: r["sums"] for r in parts.collect()}            # one row per fit
    return np.array([found[k] for k in sorted(found)])


def _sums(fits: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(np.arange(0, total.size + 1, total.shape[1], dtype=np.int32), total.ravel())
    return pa.RecordBatch.from_arrays([pa.array(fits, pa.int32()), lists], names=["fit", "sums"])


def _solved(information: np.ndarray, gradient: np.ndarray) -> np.ndarray:
    """Newton steps; directions without information stay where they are."""
    values, vectors = np.linalg.eigh(information)
    floor = 1e-12 * values[:, -1:]
    inverse = np.where(values > floor, 1.0 / np.where(values > floor, values, 1.0), 0.0)
    along = np.einsum("kji,kj->ki", vectors, gradient)
    return np.einsum("kij,kj->ki", vectors, inverse * along)


def fit_many(rows: DataFrame, names: Sequence[str], fits: int, read: Reader, l2: float = 1.0) -> Fits:
    """Logistic fits on standardised terms, a ridge of strength ``l2`` on the summed loss.

    ``rows`` has ``x`` (array of the terms) and what ``read`` needs. The penalty
    acts on each fit's own standard-deviation units; terms that are constant in a fit get 0.
    """
    names, p = list(names), len(names)
    shift = rows.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(p)], *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(p)], F.count(F.lit(1)).alias("rows")).first()
    if not shift["rows"]:
        return Fits(names, np.zeros(fits), np.zeros((fits, p)), np.full(fits, np.nan), np.zeros(fits, bool), 0)
    centre = np.array([shift[f"m{i}"] for i in range(p)])
    unit = np.array([shift[f"s{i}"] for i in range(p)])
    unit = np.where(unit > 1e-12 * np.maximum(1.0, np.abs(centre)), unit, np.inf)     # a constant term is 0 everywhere

    def moments(part, x):
        s, m, u = read(part)
        z = (x - centre) / unit
        return np.column_stack([s.sum(axis=0), m.sum(axis=0), u.sum(axis=0), u.T @ z, u.T @ (z * z)])

    sums = summed(rows, fits, moments)
    successes, totals, weight = sums[:, 0], sums[:, 1], np.maximum(sums[:, 2], 1e-300)[:, None]
    mean, square = sums[:, 3:3 + p] / weight, sums[:, 3 + p:] / weight
    variance = np.maximum(square - mean * mean, 0.0)
    alive = variance > 1e-12
    penalty = np.column_stack([np.zeros(fits), np.where(alive, l2 * variance, 1.0)])
    both = (successes > 0) & (successes < totals)
    with np.errstate(invalid="ignore", divide="ignore"):
        rate = np.where(both, np.nan, successes / totals)

    q = p + 1
    upper = np.triu_indices(q)
    open_fits = np.flatnonzero(both)
    beta = np.zeros((fits, q))
    share = np.clip(successes / np.maximum(totals, 1e-300), 1e-6, 1 - 1e-6)
    beta[:, 0] = np.log(share / (1 - share))
    best, best_loss = beta.copy(), np.full(fits, np.inf)
    converged = ~both & (totals > 0)
    passes = 0
    while len(open_fits) and passes < PASSES:
        passes += 1
        coefficients = beta[open_fits]

        def newton(part, x):
            s, m, _ = read(part)
            s, m = s[:, open_fits], m[:, open_fits]
            z = np.column_stack([np.ones(len(x)), (x - centre) / unit])
            eta = z @ coefficients.T
            mu = 1.0 / (1.0 + np.exp(-np.clip(eta, -700, 700)))
            loss = (m * np.logaddexp(0.0, eta) - s * eta).sum(axis=0)
            spread = (m * mu * (1 - mu)).T @ (z[:, upper[0]] * z[:, upper[1]])
            return np.column_stack([loss, (s - m * mu).T @ z, spread])

        got = summed(rows, len(open_fits), newton)
        pen = penalty[open_fits]
        loss = got[:, 0] + 0.5 * (pen * coefficients ** 2).sum(axis=1)
        gradient = got[:, 1:1 + q] - pen * coefficients
        information = np.zeros((len(open_fits), q, q))
        information[:, upper[0], upper[1]] = got[:, 1 + q:]
        information[:, upper[1], upper[0]] = got[:, 1 + q:]
        information[:, np.arange(q), np.arange(q)] += pen
        better = loss <= best_loss[open_fits] + 1e-10 * np.abs(loss)
        step = _solved(information, gradient)
        decrement = (step * gradient).sum(axis=1)
        at = open_fits[better]
        best[at], best_loss[at] = coefficients[better], loss[better]
        beta[at] = coefficients[better] + step[better]
        worse = open_fits[~better]
        beta[worse] = (best[worse] + coefficients[~better]) / 2
        done = better & (np.abs(decrement) <= TOLERANCE * np.maximum(1.0, loss))
        converged[open_fits[done]] = True
        open_fits = open_fits[~done]
    raw = np.where(alive, best[:, 1:] / unit, 0.0)
    intercept = best[:, 0] - raw @ centre
    return Fits(names, intercept, raw, rate, converged, passes)
