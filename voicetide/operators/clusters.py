"""k-means with several starts that gives the same clusters for any partitioning.

*Exact sums.*  Vectors are rounded to a grid of ``1 / SCALE``, and so are centres.
Products and sums of such whole numbers stay far below 2**53, so distances don't
depend on the order of additions, and sums over tasks are sums of integers.

*Seeding* is k-means|| in hash order.  A start's first candidate is the point with
the smallest hash.  Each round then takes the 2k points with the smallest
-log(u) / distance**2, where u is the point's hash for (start, round) as a number
between 0 and 1: the points that the weighted draw without replacement would give,
in one pass and without the total cost.  Candidates are weighted by the points
nearest to them and reduced to k centres by k-means++ on the driver: at most
1 + 2 k rounds of them a start.

*Training* runs all starts in one pass an iteration: the centres of all starts go
to every task, which adds up its points per (start, cluster) and returns sums.
Starts that no longer improve drop out; the start with the lowest cost wins.
Equal points are one row with their number, so copies cost nothing and can't crowd
other candidates out of a batch.

*Products* are taken in single precision where that is exact: terms are whole and not
negative, so a sum that stays below 2**24 was exact all along, and others are taken again
in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voicetide.session import importable, materialise

SCALE = 4096
ROUNDS = 2
MAX_ITERATIONS = 20
#: Relative improvement below which a start has converged.
TOLERANCE = 1e-4
BATCH = 2048
#: Whole numbers up to here are exact in single precision.
EXACT = 1 << 24


def on_grid(values: Column) -> Column:
    return F.transform(values, lambda v: F.bround(v * SCALE).cast("int"))


def points(vectors: DataFrame, features: str = "features") -> DataFrame:
    """(indices, q, h, n): distinct sparse vectors on the grid, their hash and their number."""
    parts = F.unwrap_udt(features)
    rows = vectors.select(parts["indices"].alias("indices"), on_grid(parts["values"]).alias("q"))
    counted = rows.groupBy("indices", "q").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("indices", "q", F.xxhash64("indices", "q").alias("h"), "n")


@dataclass(frozen=True)
class Clusters:
    """Centres on the grid, in order, and the cost of their start."""

    centres: np.ndarray
    cost: int

    def clusterCenters(self) -> list[np.ndarray]:
        return [c / SCALE for c in self.centres]

    def transform(self, vectors: DataFrame, features: str = "features", name: str = "_cluster") -> DataFrame:
        """Adds the number of the nearest centre, the first of equals, by integer arithmetic."""
        parts = F.unwrap_udt(features)
        grid = F.struct(parts["indices"].alias("indices"), on_grid(parts["values"]).alias("q"))
        importable(vectors.sparkSession)
        centres = self.centres

        def nearest(points: pa.Array) -> pa.Array:
            batch = pa.RecordBatch.from_struct_array(points)
            found = [np.zeros(0, np.int32)]
            for first in range(0, batch.num_rows, BATCH):
                x = dense(batch.slice(first, BATCH), centres.shape[1])
                found.append(away_from(x, centres).argmin(axis=1).astype(np.int32))
            return pa.array(np.concatenate(found))

        nearest.__annotations__ = {"points": pa.Array, "return": pa.Array}
        return vectors.withColumn(name, F.arrow_udf(nearest, "int")(grid))


def dense(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """The points of a batch as rows of whole numbers."""
    lists = batch.column(0)
    counts = np.diff(lists.offsets.to_numpy())
    out = np.zeros((batch.num_rows, size), np.float32)
    out[np.repeat(np.arange(batch.num_rows), counts), lists.flatten().to_numpy()] = batch.column(1).flatten().to_numpy()
    return out


def squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x, dtype=float)


def away_from(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of ``dense`` points that aren't negative: exact."""
    product = (x @ centres.T.astype(np.float32)).astype(float)
    unsure = np.flatnonzero((product >= EXACT).any(axis=1))
    if len(unsure):
        product[unsure] = x[unsure].astype(float) @ centres.T.astype(float)
    c = centres.astype(float)
    return squares(x)[:, None] - 2 * product + (c * c).sum(axis=1)


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances; exact, as all numbers are whole and small."""
    c = centres.astype(float)
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)


def uniform(h: np.ndarray, *keys: int) -> np.ndarray:
    """Numbers between 0 and 1 from hashes and keys."""
    value = h.view(np.uint64).copy()
    for key in keys:
        value = (value ^ np.uint64(key + 1)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(32)
    return ((value >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53


def sums(rows: DataFrame, starts: dict[int, np.ndarray], size: int) -> dict[int, dict]:
    """Per start: its cost, and the number and the sum of the points nearest to each centre."""

    order = list(starts)
    every = np.vstack([starts[s] for s in order])
    first_of = np.cumsum([0, *[len(starts[s]) for s in order]])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(every), size + 2), np.int64)
        for whole in batches:
            for first in range(0, whole.num_rows, BATCH):
                part = whole.slice(first, BATCH)
                x, n = dense(part, size), part.column(2).to_numpy()
                away = away_from(x, every)
                # sums of at most BATCH small whole numbers: exact, in doubles where copies count
                kind = np.float32 if n.sum() * SCALE <= EXACT else float
                member = np.zeros((len(every), len(x)), kind)
                each = np.arange(len(x))
                for a, b in zip(first_of, first_of[1:]):
                    near = a + away[:, a:b].argmin(axis=1)
                    member[near, each] = n
                    total[:, size] += np.bincount(near, n, minlength=len(every)).astype(np.int64)
                    cost = np.bincount(near, n * away[each, near], minlength=len(every))
                    total[:, size + 1] += cost.astype(np.int64)
                total[:, :size] += (member @ x.astype(kind, copy=False)).astype(np.int64)
        row, dim = np.nonzero(total)
        start = np.searchsorted(first_of, row, side="right") - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(order)[start], pa.int32()), pa.array(row - first_of[start], pa.int32()),
             pa.array(dim, pa.int32()), pa.array(total[row, dim])],
            ["start", "cluster", "dim", "value"],
        )

    added = rows.select("indices", "q", "n").mapInArrow(add, "start int, cluster int, dim int, value long")
    out = {s: {"n": np.zeros(len(c), np.int64), "cost": 0, "sum": np.zeros((len(c), size), np.int64)} for s, c in starts.items()}
    # at most starts x clusters x features numbers
    for r in added.groupBy("start", "cluster", "dim").agg(F.sum("value").alias("value")).collect():
        found = out[r.start]
        if r.dim == size:
            found["n"][r.cluster] = r.value
        elif r.dim == size + 1:
            found["cost"] += r.value
        else:
            found["sum"][r.cluster, r.dim] = r.value
    return out


def nearest_draws(rows: DataFrame, known: dict[int, np.ndarray], round_: int, most: int, size: int, seed: int) -> dict[int, np.ndarray]:
    """Per start the ``most`` distinct points drawn by squared distance from ``known``."""
    every = np.vstack(list(known.values()))
    first_of = np.cumsum([0, *[len(c) for c in known.values()]])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, dict[bytes, float]] = {s: {} for s in known}
        for whole in batches:
            for first in range(0, whole.num_rows, BATCH):
                part = whole.slice(first, BATCH)
                x, h = dense(part, size), part.column(2).to_numpy()
                far = away_from(x, every)
                for (s, _), a, b in zip(known.items(), first_of, first_of[1:]):
                    away = far[:, a:b].min(axis=1)
                    keys = np.where(away > 0, -np.log(uniform(h, seed, s, round_)) / np.maximum(away, 1), np.inf)
                    for i in np.argsort(keys, kind="stable")[:most].tolist():
                        if keys[i] < np.inf:
                            best[s].setdefault(x[i].astype("<i4").tobytes(), float(keys[i]))
                    best[s] = dict(sorted(best[s].items(), key=lambda e: (e[1], e[0]))[:most])
        found = [(s, k, v) for s, some in best.items() for v, k in some.items()]
        columns = list(zip(*found, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.binary())],
            ["start", "key", "vector"],
        )

    drawn = rows.select("indices", "q", "h").mapInArrow(draw, "start int, key double, vector binary").distinct()
    place = F.row_number().over(Window.partitionBy("start").orderBy("key", "vector"))
    chosen = drawn.withColumn("rn", place).filter(F.col("rn") <= most).collect()
    return {
        s: np.vstack([c, *[np.frombuffer(r.vector, "<i4") for r in sorted(chosen, key=lambda r: r.rn) if r.start == s]])
        for s, c in known.items()
    }


def reduce_candidates(candidates: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k of the weighted candidates by k-means++, moved by a few local iterations."""
    x, w = candidates.astype(float), np.maximum(weights.astype(float), 0)
    chosen = [int(np.argmax(w))]
    while len(chosen) < min(k, len(x)):
        mass = w * np.maximum(distances(x, candidates[chosen]).min(axis=1), 0)
        if mass.sum() <= 0:
            break
        chosen.append(int(np.searchsorted(np.cumsum(mass), rng.random() * mass.sum())))
    centres = candidates[chosen].astype(np.int64)
    for _ in range(10):
        near = distances(x, centres).argmin(axis=1)
        for c in range(len(centres)):
            mine = w * (near == c)
            if mine.sum() > 0:
                centres[c] = np.rint((mine[:, None] * x).sum(axis=0) / mine.sum())
    return centres


def kmeans(vectors: DataFrame, k: int, size: int, starts: int = 10, seed: int = 42, features: str = "features") -> Clusters:
    """The best of ``starts`` clusterings of ``size``-dimensional vectors of length at most one."""
    importable(vectors.sparkSession)
    rows = materialise(points(vectors, features), "points")
    first = rows.select(
        *[F.min_by(F.struct("indices", "q"), F.xxhash64("h", F.lit(seed), F.lit(s))).alias(f"s{s}") for s in range(starts)]
    ).first()
    known = {}
    for s in range(starts):
        known[s] = np.zeros((1, size), np.int64)
        if first[s] is not None:
            known[s][0, first[s].indices] = first[s].q
    for round_ in range(ROUNDS):
        known = nearest_draws(rows, known, round_, 2 * k, size, seed)
    weighed = sums(rows, known, size)
    open_ = {s: reduce_candidates(c, weighed[s]["n"], k, np.random.default_rng((seed, s))) for s, c in known.items()}
    done: dict[int, tuple[int, np.ndarray]] = {}
    last = dict.fromkeys(open_, math.inf)
    for _ in range(MAX_ITERATIONS):
        found = sums(rows, open_, size)
        following = {}
        for s, centres in open_.items():
            cost = found[s]["cost"]
            done[s] = cost, centres
            if last[s] - cost > TOLERANCE * cost:
                n = np.maximum(found[s]["n"], 1)[:, None]
                moved = (2 * found[s]["sum"] + n) // (2 * n)  # rounded in integers
                following[s] = np.where(found[s]["n"][:, None] > 0, moved, centres)
            last[s] = cost
        open_ = following
        if not open_:
            break
    cost, centres = done[min(done, key=lambda s: (done[s][0], s))]
    order = sorted(range(len(centres)), key=lambda i: centres[i].tolist(), reverse=True)
    return Clusters(centres[order], cost)
