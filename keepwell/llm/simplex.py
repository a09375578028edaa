"""Centroid clustering in integers, filtered by an n-simplex projection.

Every kept vector is turned into integers once. Its squared distances to a few
pivots are computed once too and turned into apex coordinates: the foot of the
vector in the plane of the pivots and its height above it. Apexes and vectors are
cached as a table. In a round, foot and height of vector and centroid bound their
distance from both sides (heights on the same and on opposite sides of the
plane); centroids whose lower bound is above the smallest upper bound are left
out, the others are compared exactly. Per task and cluster one exact sum goes on.

Pivots are chosen greedily among at most SAMPLE vectors for their height above
the pivots so far; with all vectors equal there is one pivot and the bounds come
from the heights alone. Pivots change the work, never the result.

Exactness: integers up to 2**27 are compared in 64 bits (64 squares stay below
2**63), larger ones as Python integers; sums travel as 32-bit limbs.

Edge cases: a null embedding, another number of components, a null or non-finite
component (also one that is infinite times ``scale``) leaves the row out. Equal ids
are vectors of their own; the first centroids then go by id hash and components;
null ids come last. With fewer vectors than clusters there are as many clusters
as vectors; no vectors give no rows. A distance or inertia beyond 64 bits is null.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.tables import written

PIVOTS, SAMPLE = 16, 64
#: A pivot adds a dimension only if it stands this far above the others, relative to the largest distance.
LEAST_HEIGHT = 0.05
#: Bounds are widened by this share of the squared distances from the first pivot: with the
#: condition that LEAST_HEIGHT and CONDITION allow, rounding moves a product of heights by
#: less than 5e-6 of them.
SLACK, CONDITION = 1e-5, 1e4
NARROW = float(1 << 27)
BLOCK = 8192
LIMB = 32
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def whole(block: np.ndarray) -> np.ndarray:
    """Integers that sums of 64 squares can hold: 64-bit ones, or Python's beyond NARROW."""
    if np.abs(block).max(initial=0.0) <= NARROW:
        return block.astype(np.int64)
    return np.array([[int(x) for x in row] for row in block.tolist()], object).reshape(block.shape)


def squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two integer blocks, all against all."""
    if left.dtype == object or right.dtype == object:
        left, right = left.astype(object), right.astype(object)
    out = np.empty((len(left), len(right)), left.dtype)
    for j, r in enumerate(right):
        d = left - r
        out[:, j] = (d * d).sum(axis=1)
    return out


@dataclass
class Simplex:
    """Pivots with the Cholesky factor of their edge products; turns squared distances into apexes."""

    pivots: np.ndarray
    edges: np.ndarray      # exact squared distances of the later pivots from the first
    factor: np.ndarray

    @classmethod
    def of(cls, sample: np.ndarray, most: int = PIVOTS) -> Simplex:
        """Greedy choice: the vector that stands highest above the pivots so far."""
        every = squared(sample, sample)
        chosen, far = [0], float(max(every.max(), 1))
        heights = every[:, 0].astype(float)
        factor = np.zeros((0, 0))
        while len(chosen) <= most:
            k = int(heights.argmax())
            if heights[k] < LEAST_HEIGHT ** 2 * far or k in chosen:
                break
            gram = cls._gram(every, chosen + [k])
            taller = np.linalg.cholesky(gram)
            if np.linalg.cond(taller) > CONDITION:
                break
            chosen, factor = chosen + [k], taller
            feet = np.linalg.solve(factor, cls._products(every, chosen))
            heights = every[:, 0].astype(float) - (feet ** 2).sum(axis=0)
        return cls(sample[chosen], every[chosen[1:], 0], factor)

    @staticmethod
    def _products(every: np.ndarray, chosen: list[int]) -> np.ndarray:
        """Products of the edges to the later pivots with the edges to all vectors, from exact distances."""
        first, rest = chosen[0], chosen[1:]
        return np.array([(every[:, first] + every[p, first] - every[:, p]).astype(float) / 2 for p in rest])

    @classmethod
    def _gram(cls, every: np.ndarray, chosen: list[int]) -> np.ndarray:
        return cls._products(every, chosen)[:, chosen[1:]]

    def apex(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Foot and height as one row per vector, and its squared distance from the first pivot."""
        d = squared(vectors, self.pivots)
        near = d[:, 0].astype(float)
        if not len(self.edges):
            return np.sqrt(near)[:, None], near
        products = ((d[:, :1] + self.edges[None, :]) - d[:, 1:]).astype(float) / 2
        feet = np.linalg.solve(self.factor, products.T).T
        height = np.sqrt(np.maximum(near - (feet ** 2).sum(axis=1), 0.0))
        return np.column_stack([feet, height]), near


@dataclass
class Model:
    """Centroids of a round with their apexes; ``settled`` counts rows that the bounds alone decided."""

    simplex: Simplex
    centroids: list[list[int]]

    def __post_init__(self):
        self.vectors = whole(np.array(self.centroids, float)) if self._doubles() else np.array(self.centroids, object)
        self.apex, self.near = self.simplex.apex(self.vectors)
        self.settled = 0

    def _doubles(self) -> bool:
        return max((abs(x) for row in self.centroids for x in row), default=0) <= NARROW

    def candidates(self, apex: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Which centroids may be the nearest. Values that overflow rule nothing out."""
        with np.errstate(all="ignore"):
            base = near[:, None] + self.near[None, :]
            feet = apex[:, :-1] @ self.apex[:, :-1].T
            heights = np.outer(apex[:, -1], self.apex[:, -1])
            slack = SLACK * base
            lower = base - 2 * (feet + heights) - slack
            upper = base - 2 * (feet - heights) + slack
            return ~(lower > upper.min(axis=1)[:, None])

    def nearest(self, vectors: np.ndarray, apex: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid by exact distance; ties go to the smaller number."""
        left = self.candidates(apex, near)
        cluster = left.argmax(axis=1)
        open_rows = np.flatnonzero(left.sum(axis=1) > 1)
        self.settled += len(left) - len(open_rows)
        if not len(open_rows):
            return cluster
        rows, columns = np.nonzero(left[open_rows])
        x, c = vectors[open_rows[rows]], self.vectors[columns]
        if x.dtype == object or c.dtype == object:
            x, c = x.astype(object), c.astype(object)
        d = x - c
        exact = (d * d).sum(axis=1)
        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        if exact.dtype == object:
            ends = np.r_[starts[1:], len(rows)]
            best = np.array([a + min(range(b - a), key=lambda i: (exact[a + i], i)) for a, b in zip(starts, ends)])
        else:
            least = np.minimum.reduceat(exact, starts)
            hit = np.flatnonzero(exact == np.repeat(least, np.diff(np.r_[starts, len(rows)])))
            best = hit[np.searchsorted(hit, starts)]
        cluster[open_rows] = columns[best]
        return cluster

    def distances(self, vectors: np.ndarray, cluster: np.ndarray) -> list[int]:
        c = self.vectors[cluster]
        x = vectors
        if x.dtype == object or c.dtype == object:
            x, c = x.astype(object), c.astype(object)
        d = x - c
        return (d * d).sum(axis=1).tolist()


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, float).reshape(-1, width)


def _blocks(batches: Iterator[pa.RecordBatch], *widths: tuple[str, int]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, *(_matrix(part.column(name), width) for name, width in widths)


def _projected(simplex: Simplex, size: int):
    def run(batches):
        for part, x in _blocks(batches, ("x", size)):
            apex, near = simplex.apex(whole(x))
            lists = [pa.ListArray.from_arrays(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32), m.ravel()) for m in (x, apex)]
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), *lists, pa.array(near)], names=["vec_id", "x", "apex", "near"])
    return run


def _partial_sums(model: Model, size: int):
    """One exact sum per task, cluster and component, as signed limbs."""
    def run(batches):
        k, width = len(model.centroids), model.apex.shape[1]
        sums, counts = [[0] * size for _ in range(k)], [0] * k
        for part, x, apex in _blocks(batches, ("x", size), ("apex", width)):
            vectors = whole(x)
            cluster = model.nearest(vectors, apex, part.column("near").to_numpy())
            for c in np.unique(cluster).tolist():
                mine = vectors[cluster == c]
                counts[c] += len(mine)
                sums[c] = [a + int(b) for a, b in zip(sums[c], mine.sum(axis=0))]
        out = [(c, place, limb, part) for c in range(k) if counts[c] for place, value in enumerate([counts[c], *sums[c]]) for limb, part in _limbs(value)]
        if out:
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64())],
                                             names=["cluster", "place", "limb", "part"])
    return run


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    sign, value, limb = (-1 if value < 0 else 1), abs(value), 0
    while True:
        yield limb, sign * (value & ((1 << LIMB) - 1))
        value, limb = value >> LIMB, limb + 1
        if not value:
            return


def _assigned(model: Model, size: int):
    def run(batches):
        for part, x, apex in _blocks(batches, ("x", size), ("apex", model.apex.shape[1])):
            vectors = whole(x)
            cluster = model.nearest(vectors, apex, part.column("near").to_numpy())
            distance = [d if d < 1 << 63 else None for d in model.distances(vectors, cluster)]
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                                             names=["vec_id", "cluster", "distance"])
    return run


def kept_vectors(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """(vec_id, x) with x the floors of scale times the components, as whole doubles."""
    wide = F.transform(F.col("embedding").cast("array<double>"), lambda v: v * F.lit(float(scale)))
    good = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    kept = vectors.select("vec_id", wide.alias("wide")).where((F.size("wide") == size) & F.forall("wide", good))
    return kept.mapInArrow(_floors(size), "vec_id long, x array<double>")


def _floors(size: int):
    def run(batches):
        for part, wide in _blocks(batches, ("wide", size)):
            flat = np.floor(wide).ravel()
            x = pa.ListArray.from_arrays(np.arange(0, flat.size + 1, size, dtype=np.int32), flat)
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), x], names=["vec_id", "x"])
    return run


def _seed_order() -> list[Column]:
    return [F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")).cast("binary"), 256).asc_nulls_last(), F.col("x")]


def _update(points: DataFrame, model: Model, size: int) -> list[list[int]]:
    """Floors of the exact means; an empty cluster keeps its centroid."""
    parts = points.mapInArrow(_partial_sums(model, size), "cluster int, place int, limb int, part long")
    totals: dict[tuple[int, int], int] = {}
    # at most clusters x (size + 1) x limbs rows
    for r in parts.groupBy("cluster", "place", "limb").agg(F.sum("part").alias("part")).collect():
        key = (r["cluster"], r["place"])
        totals[key] = totals.get(key, 0) + (r["part"] << (LIMB * r["limb"]))
    return [[totals[c, i + 1] // totals[c, 0] for i in range(size)] if (c, 0) in totals else old for c, old in enumerate(model.centroids)]


def clustered(vectors: DataFrame, clusters: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, pivots: int = PIVOTS) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    kept = written(kept_vectors(vectors, size, scale), "vectors")
    first = [r["x"] for r in kept.orderBy(*_seed_order()).limit(max(SAMPLE, clusters)).collect()]
    if not first:
        return spark.createDataFrame([], RESULT)
    simplex = Simplex.of(whole(np.array(first)), pivots)
    points = written(kept.mapInArrow(_projected(simplex, size), "vec_id long, x array<double>, apex array<double>, near double"), "apexes")
    model = Model(simplex, [[int(x) for x in row] for row in first[:clusters]])
    for _ in range(rounds):
        moved = _update(points, model, size)
        if moved == model.centroids:
            break  # the rounds left would repeat this one
        model = Model(simplex, moved)
    labelled = written(points.mapInArrow(_assigned(model, size), "vec_id long, cluster int, distance long"), "clusters")
    known = F.count("distance") == F.count(F.lit(1))
    sums = labelled.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d"), known.alias("known")).collect()
    fits = lambda d: d if d is not None and d < 1 << 63 else None
    own = {r["cluster"]: int(r["d"]) if r["known"] else None for r in sums}
    total = fits(sum(own.values())) if None not in own.values() else None
    rows = [(c, fits(d), total, hashlib.sha256(",".join(map(str, model.centroids[c])).encode()).hexdigest()) for c, d in own.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return labelled.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
