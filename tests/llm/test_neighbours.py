import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voicetide.llm import neighbours as nb
from voicetide.llm.graph import components

SCHEMA = "vec_id long, embedding array<float>, label int, size int, rep string"


def expected(rows, threshold=nb.THRESHOLD):
    good = []
    for i, (vec_id, v) in enumerate(rows):
        if vec_id is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, np.float32).astype(np.float64)
        good.append((i, x / np.linalg.norm(x)))
    links, part = [0] * len(rows), [r[0] for r in rows]
    for a, (i, x) in enumerate(good):
        for j, y in good[:a]:
            if len(x) == len(y) and float(x @ y) >= threshold - 1e-15:
                links[i] += 1
                links[j] += 1
                old, new = max(part[i], part[j]), min(part[i], part[j])
                part = [new if p == old else p for p in part]
    return sorted((str(r[0]), n, str(p)) for r, n, p in zip(rows, links, part, strict=True))


def found(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 0, 1, "clash") for i, v in rows], SCHEMA)
    out = nb.near_duplicates(frame, **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in out)


def clustered(seed, n, dim, noise):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(max(2, n // 12), dim))
    return (centers[rng.integers(0, len(centers), n)] + noise * rng.normal(size=(n, dim))).astype(np.float32)


@pytest.mark.parametrize("block_rows", [10_000, 40])
@pytest.mark.parametrize("noise", [0.1, 0.33])
def test_against_all_pairs(spark, block_rows, noise):
    values = clustered(1, 220, 16, noise)
    rows = [(int(i * 3 + 1), v.tolist()) for i, v in enumerate(values)]
    assert found(spark, rows, block_rows=block_rows) == expected(rows)


def test_cases(spark):
    rows = [
        (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]),
        (7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (None, [1.0, 0.0]),
        (10, [1.0, 0.0, 0.0]), (11, [-1.0, 0.0]), (12, [1e-30, 0.0]), (13, [3e38, 1e38]), (14, [-0.0, 5.0]),
    ]
    assert found(spark, rows) == expected(rows)
    assert found(spark, []) == []


def test_a_large_group_of_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(400)] + [(1000, [1.0, 2.0, 3.1]), (1001, [-3.0, 0.0, 1.0])]
    assert found(spark, rows) == expected(rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 70), st.sampled_from([0.5, 0.9, 0.99, 1.0]))
def test_no_pair_is_lost_or_invented(seed, dim, threshold):
    values = clustered(seed, 60, dim, 0.3).astype(np.float64)
    unit = values / np.linalg.norm(values, axis=1)[:, None]
    parts = (unit, *nb.quantise(unit))
    x, y, again = nb.strip_links(parts, parts, threshold)
    exact = np.einsum("id,jd->ij", unit, unit)
    clear = np.abs(exact - threshold) > 1e-12
    made = np.zeros_like(exact, bool)
    made[x, y] = True
    assert (made == (exact >= threshold))[clear].all()
    assert again <= exact.size


def test_bounds_hold():
    values = clustered(7, 300, 64, 0.5).astype(np.float64)
    unit = values / np.linalg.norm(values, axis=1)[:, None]
    q, s, a, e = nb.quantise(unit)
    product = (q.astype(np.int64) @ q.astype(np.int64).T) * s[:, None] * s[None, :]
    bound = a[:, None] * e + e[:, None] * a + e[:, None] * e
    assert (np.abs(product - unit @ unit.T) <= bound).all() and bound.max() < 0.05


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100 + i, 100) for i in range(1, 80)] + [(7, 7), (None, 3)]
    links = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(80)}
    assert components(links.limit(0)).count() == 0
