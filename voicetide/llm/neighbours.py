"""Embedding near-dedup by int8 tile products with rigorous error bounds.

Equal vectors are merged into classes first.  Class representatives are dealt
into blocks of about ``BLOCK_ROWS``; every pair of blocks is a tile, one task.
In a tile each unit vector u is quantised to s*q with int8 q, and its error
norm e = |u - s q| is known, so

    |u.v - s_u s_v (q_u.q_v)|  <=  a_u e_v + e_u a_v + e_u e_v,   a = |s q|.

The integer products are exact (single precision holds them for up to 1040
components, double beyond).  A pair whose product plus bound is below the
threshold is no link, one whose product minus bound reaches it is a link, and
only the rest is computed again in double precision.

A tile returns, for each vector with a link in it, the number of linked vectors
and the smallest vector of its component there: never pairs.  So a group of
near copies of any size gives one row per vector and tile, and the components
over all tiles come out right.

Defined results.  Vectors that are null, empty, zero or hold null or non-finite
components, and rows without an id, link with nothing.  Vectors of different
length don't link.  Repeated rows are vectors of their own; rows that share an
id share its component.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voicetide.llm.base import written
from voicetide.llm.graph import components

THRESHOLD = 0.9
BLOCK_ROWS = 4096
#: Rows of one block that are multiplied with the other block at a time.
STRIP_ROWS = 1024
#: For the rounding of double-precision norms and products.
SLACK = 1e-12
EXACT_SINGLE = 1040


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(q, s, a, e): int8 values, scales, norms of s*q, norms of the errors."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None])
    rebuilt = q * scale[:, None]
    error = np.linalg.norm(unit - rebuilt, axis=1) + SLACK
    return q.astype(np.int8), scale, np.linalg.norm(rebuilt, axis=1) + SLACK, error


def strip_links(
    left: tuple, right: tuple, threshold: float
) -> tuple[np.ndarray, np.ndarray, int]:
    """Positions of the linked pairs of two sets, and how many were computed again.

    Each set is (unit vectors, q, s, a, e).
    """
    u, q, s, a, e = left
    v, r, t, b, f = right
    kind = np.float32 if u.shape[1] <= EXACT_SINGLE else np.float64
    product = q.astype(kind) @ r.astype(kind).T
    # the widest bound of the strip decides what is looked at closely
    widest = a.max() * f.max() + e.max() * b.max() + e.max() * f.max()
    least = (threshold - widest) / np.maximum(s.astype(np.float64), 1e-300)
    rough = product * t.astype(kind)[None, :]
    # single precision scales carry a relative error of about 1e-7
    x, y = np.nonzero(rough >= (least - 1e-5 * np.abs(least) - 1e-5)[:, None].astype(kind))
    value = product[x, y].astype(np.float64) * s[x] * t[y]
    bound = a[x] * f[y] + e[x] * b[y] + e[x] * f[y] + SLACK
    sure = value - bound >= threshold
    open_pairs = np.flatnonzero(~sure & (value + bound >= threshold))
    linked = sure
    for first in range(0, len(open_pairs), 65_536):
        part = open_pairs[first : first + 65_536]
        linked[part] = np.einsum("ij,ij->i", u[x[part]], v[y[part]]) >= threshold
    return x[linked], y[linked], len(open_pairs)


def _merge(labels: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Joins the components of linked nodes; a label is the smallest node."""
    while len(x):
        a, b = labels[x], labels[y]
        apart = a != b
        x, y = x[apart], y[apart]
        if not len(x):
            return
        np.minimum.at(labels, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels[:] = jumped


def tile_links(tile: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Per vector with a link in this tile: linked vectors, smallest vector reached."""
    i, j = int(tile["i"].iloc[0]), int(tile["j"].iloc[0])
    tile = tile.sort_values("rep", kind="stable").reset_index(drop=True)
    n = len(tile)
    unit = np.array(tile["embedding"].to_list(), np.float64)
    unit /= np.abs(unit).max(axis=1)[:, None]  # no overflow in the norm
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    parts = (unit, *quantise(unit))
    weight = tile["size"].to_numpy(np.int64)
    block = tile["block"].to_numpy()
    rows, columns = np.flatnonzero(block == i), np.flatnonzero(block == j)
    labels, links = np.arange(n), np.zeros(n, np.int64)
    right = tuple(p[columns] for p in parts)
    for first in range(0, len(rows) if len(columns) else 0, STRIP_ROWS):
        strip = rows[first : first + STRIP_ROWS]
        x, y, _ = strip_links(tuple(p[strip] for p in parts), right, threshold)
        x, y = strip[x], columns[y]
        if i == j:
            x, y = x[x != y], y[x != y]
        links += np.bincount(x, weights=weight[y], minlength=n).astype(np.int64)
        if i != j:
            links += np.bincount(y, weights=weight[x], minlength=n).astype(np.int64)
        _merge(labels, x, y)
    reps = tile["rep"].to_numpy()
    some = links > 0
    return pd.DataFrame({"rep": reps[some], "low": reps[labels[some]], "links": links[some]})


def classes(vectors: DataFrame) -> DataFrame:
    """Usable vectors, equal ones once: ``embedding``, ``rep`` (smallest id), ``size``."""
    values = F.col("embedding")
    usable = (
        F.col("vec_id").isNotNull()
        & (F.size(values) > 0)
        & F.forall(values, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(values, lambda x: x != 0)
    )
    return (
        vectors.filter(F.coalesce(usable, F.lit(False)))
        .groupBy(F.col("embedding").cast("array<double>").alias("embedding"))
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size"))
    )


def tiles(reps: DataFrame, n: int, block_rows: int) -> DataFrame:
    """Every representative once for each block its own block meets."""
    blocks = max(1, math.ceil(n / block_rows))
    block = F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    return (
        reps.select("*", block.alias("block"), F.size("embedding").alias("dim"))
        .select("*", other.alias("_other"))
        .select(
            "rep", "size", "embedding", "block", "dim",
            F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j"),
        )
    )


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding")
    )
    reps = written(classes(rows), "classes")

    def links(tile: pd.DataFrame) -> pd.DataFrame:
        return tile_links(tile, threshold)

    found = written(
        tiles(reps, reps.count(), block_rows).groupBy("dim", "i", "j")
        .applyInPandas(links, "rep long, low long, links long"),
        "links",
    )
    degree = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found, "rep", "low").select(
        F.col("node").alias("rep"), F.col("component")
    )
    known = (
        reps.join(degree, "rep", "left").join(joined, "rep", "left")
        .select(
            F.col("embedding").alias("_vector"),
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("_links"),
            F.coalesce("component", "rep").alias("_component"),
        )
    )
    of = F.col("embedding").cast("array<double>") == F.col("_vector")
    placed = rows.join(known, of & F.col("vec_id").isNotNull(), "left")
    component = F.coalesce("_component", "vec_id")
    return placed.select(
        "vec_id",
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
