"""k-means: equal for any partitioning, best of its starts, nearest centres."""

import random

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import types as T

from voicetide.operators import clusters as km

SIZE = 12


def sample(n=300, groups=4, seed=3):
    """Unit vectors around ``groups`` directions; every third is one and the same point."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        if i % 3 == 0:
            out.append(SparseVector(SIZE, {0: 0.6, 1: 0.8}))
            continue
        g = i % groups
        v = {3 * g % SIZE: 1.0, (3 * g + 1) % SIZE: draw.random(), draw.randrange(SIZE): 0.3 * draw.random()}
        length = sum(x * x for x in v.values()) ** 0.5
        out.append(SparseVector(SIZE, {k: x / length for k, x in v.items()}))
    return out


def frame(spark, vectors, parts):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("features", VectorUDT())])
    return spark.createDataFrame(list(enumerate(vectors)), schema).repartition(parts)


@pytest.fixture(scope="module")
def found(spark):
    return {parts: km.kmeans(frame(spark, sample(), parts), 4, SIZE, starts=3) for parts in (1, 7)}


def test_partitioning_changes_nothing(found):
    assert (found[1].centres == found[7].centres).all() and found[1].cost == found[7].cost


def test_no_start_alone_is_better(spark, found):
    rows = frame(spark, sample(), 2)
    alone = km.kmeans(rows, 4, SIZE, starts=1)
    assert found[1].cost <= alone.cost
    x = np.rint(np.array([v.toArray() for v in sample()]) * km.SCALE)
    assert found[1].cost == int(km.distances(x, found[1].centres).min(axis=1).sum())


def test_nearest_centres(spark, found):
    model = found[1]
    for row in model.transform(frame(spark, sample(), 3)).collect():
        away = km.distances(np.rint(row.features.toArray() * km.SCALE)[None], model.centres)[0]
        assert row._cluster == int(away.argmin())


def test_the_groups_are_found(spark, found):
    rows = found[1].transform(frame(spark, sample(), 2)).toPandas()
    assert set(rows._cluster) == {0, 1, 2, 3}


def test_fewer_points_than_clusters_and_empty_vectors(spark):
    few = [SparseVector(SIZE, {}), SparseVector(SIZE, {2: 1.0}), SparseVector(SIZE, {2: 1.0})]
    model = km.kmeans(frame(spark, few, 2), 5, SIZE, starts=2)
    assert model.cost == 0 and len(model.centres) == 2
    assert Vectors.dense(model.clusterCenters()[0]).norm(2) == pytest.approx(1)


def test_copies_are_counted_and_cost_no_row(spark):
    many = sample(40) * 30
    rows = km.points(frame(spark, many, 3))
    distinct = {tuple(zip(v.indices.tolist(), np.rint(v.values * km.SCALE).tolist())) for v in many}
    assert rows.count() == len(distinct) and rows.agg({"n": "sum"}).first()[0] == len(many)
    x = np.rint(np.array([v.toArray() for v in many]) * km.SCALE)
    model = km.kmeans(frame(spark, many, 3), 4, SIZE, starts=2)
    assert model.cost == int(km.distances(x, model.centres).min(axis=1).sum())


def test_copies_crowd_no_candidate_out(spark):
    # one batch holds far more copies of the first points than a draw takes
    many = [SparseVector(SIZE, {0: 1.0})] * 900 + [SparseVector(SIZE, {i: 1.0}) for i in range(1, SIZE)]
    found = km.nearest_draws(km.points(frame(spark, many, 1)), {0: np.eye(1, SIZE, 5, dtype=np.int64) * km.SCALE}, 0, SIZE, SIZE, 1)
    assert len({tuple(c) for c in found[0].tolist()}) == SIZE


def test_single_precision_is_exact():
    draw = np.random.default_rng(4)
    unit = np.abs(draw.normal(size=(500, 60)))
    x = np.rint(unit / np.linalg.norm(unit, axis=1)[:, None] * km.SCALE)
    centres = np.vstack([x[:40], np.rint(x.mean(axis=0))]).astype(np.int64)
    assert (centres.astype(float) @ centres.T.astype(float)).max() > km.EXACT  # beyond what is exact
    assert (km.away_from(x.astype(np.float32), centres) == km.distances(x, centres)).all()
