import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voicetide.llm import prob_minhash as pm


def brute_jp(x, y):
    a = dict(zip(x[0].tolist(), x[1].tolist(), strict=True))
    b = dict(zip(y[0].tolist(), y[1].tolist(), strict=True))
    return sum(
        1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys())
        for d in a.keys() & b.keys()
    )


def words(seed, n):
    draw = random.Random(seed)
    return [f"w{draw.randrange(400)}" for _ in range(n)]


def edited(w, seed, share):
    draw = random.Random(seed)
    w = list(w)
    for i in draw.sample(range(len(w)), int(share * len(w))):
        w[i] = f"x{draw.randrange(10**6)}"
    return w


@pytest.mark.parametrize("share", [0.0, 0.01, 0.04, 0.2])
def test_jaccard_and_its_estimate(share):
    w = words(1, 500)
    x, y = pm.shingles(" ".join(w + w[:80])), pm.shingles(" ".join(edited(w, 2, share) + w[:160]))
    exact = brute_jp(x, y)
    assert abs(pm.probability_jaccard(x, y) - exact) < 1e-9
    salted = [np.uint64(k * 7919) for k in range(30)]
    found = np.mean([(pm.signature(x[0] ^ s, x[1]) == pm.signature(y[0] ^ s, y[1])).mean() for s in salted])
    assert abs(found - exact) < 4 * np.sqrt(max(exact * (1 - exact), 0.01) / (30 * pm.REGISTERS))


def test_registers_follow_the_weights():
    ids, weights = np.arange(3, dtype=np.uint64), np.array([1.0, 2.0, 7.0])
    kept = np.concatenate([pm.signature(ids ^ np.uint64(k << 20), weights) & np.uint64(3) for k in range(200)])
    share = np.bincount(kept.astype(int), minlength=3) / len(kept)
    assert np.allclose(share, [0.1, 0.2, 0.7], atol=0.02)


def test_no_shingles_and_short_texts():
    assert len(pm.shingles(None)[0]) == len(pm.shingles(" \n")[0]) == 0
    assert len(pm.shingles("a b")[0]) == 1 and pm.shingles("a b")[0] != pm.shingles("b a")[0]
    assert pm.probability_jaccard(pm.shingles(""), pm.shingles("a")) == 0


def expected(texts, threshold=pm.THRESHOLD):
    """Classes by comparing all pairs."""
    bags = [pm.shingles(t) for t in texts]
    part = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if pm.probability_jaccard(bags[i], bags[j]) >= threshold:
                old, new = max(part[i], part[j]), min(part[i], part[j])
                part = [new if p == old else p for p in part]
    return part


def frame(spark, texts):
    rows = [(i, t, "en", "s", 1, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, key string"
    )


def test_classes_against_all_pairs(spark):
    texts = []
    for family in range(6):
        w = words(family, 120)
        texts += [" ".join(edited(w, 100 * family + k, 0.006 * (k % 6))) for k in range(9)]
    texts += [texts[0], texts[0], None, "", "a b", "a b", "a c"]
    order = list(range(len(texts)))
    random.Random(5).shuffle(order)
    texts = [texts[i] for i in order]
    want = expected(texts)
    found = {r.doc_id: r for r in pm.classify(frame(spark, texts)).collect()}
    assert [found[i].class_id for i in range(len(texts))] == want
    assert [found[i].kept for i in range(len(texts))] == [w == i for i, w in enumerate(want)]


def test_links_beside_the_leader_are_found(spark, monkeypatch):
    """With one band of one register everything shares few buckets, and most members
    are not near their leader."""
    monkeypatch.setattr(pm, "TILE_ROWS", 4)
    texts = []
    for family in range(12):
        w = words(family, 100) + words(99, 330)  # a long common part: far from the threshold
        texts += [" ".join(edited(w, 10 * family + k, 0.002 * k)) for k in range(3)]
    want = expected(texts)
    assert 12 <= len(set(want)) < 36

    def one_bucket(signed):
        return np.zeros(1, np.int64)

    docs = frame(spark, texts)
    signed = pm.sign(docs)
    monkeypatch.setattr(pm, "sign", lambda d: signed.withColumn("bands", F.array(F.lit(1).cast("long"))))
    found = {r.doc_id: r.class_id for r in pm.classify(docs).collect()}
    assert [found[i] for i in range(len(texts))] == want


def test_a_large_group_of_copies_is_linear(spark):
    w = words(3, 200)
    texts = [" ".join(edited(w, k, 0.004)) for k in range(300)] + [" ".join(w)] * 300
    docs = frame(spark, texts)
    found = pm.classify(docs).collect()
    assert {r.class_id for r in found} == {0} and sum(r.kept for r in found) == 1
    assert pm.keep_first(docs).count() == 1


def test_cases(edge, nothing):
    rows = pm.classify(edge).collect()
    assert len(rows) == edge.count()
    by_text = {}
    for r, e in zip(
        sorted(rows, key=lambda r: (r.doc_id or -1, bytes(r.key))),
        sorted(edge.select("doc_id", pm.text_key(F.coalesce("text", F.lit(""))).alias("k"), "text").collect(),
               key=lambda r: (r.doc_id or -1, bytes(r.k))), strict=True,
    ):
        by_text.setdefault((e.doc_id, e.text), []).append(r)
    assert {(r.class_id, r.kept) for r in by_text[9, "one two"]} == {(8, False)}
    assert all(r.kept for (_, t), rs in by_text.items() if not (t or "").strip() for r in rs)
    assert max(len(rs) for (i, _), rs in by_text.items() if i == 1) == 2  # the repeated row
    kept = pm.keep_first(edge)
    assert kept.columns == edge.columns
    # the repeated row and the copy of "one two" go
    assert kept.count() == edge.count() - 2
    assert pm.classify(nothing).count() == 0 and pm.keep_first(nothing).count() == 0


def test_tiles_are_bounded_on_both_sides(spark, monkeypatch):
    monkeypatch.setattr(pm, "TILE_ROWS", 50)
    rows = spark.range(400).selectExpr(
        "1L AS bucket", "id AS node", "id AS component", "400L AS size", "true AS apart", "400L AS askers"
    )
    dealt = pm.tiled(rows).collect()
    tiles = {}
    for r in dealt:
        tiles.setdefault((r.tile, r.asker_tile), ([], []))[r.asks].append(r.node)
    assert max(len(a) + len(b) for a, b in tiles.values()) <= 4 * 50
    met = [(x, y) for others, asks in tiles.values() for x in asks for y in others]
    assert len(met) == len(set(met)) == 400 * 400


def test_signatures_lose_far_fewer_pairs_than_bands():
    p, n = pm.THRESHOLD, pm.REGISTERS
    least = pm.least_agreement(p)
    lost = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1) if k / n < least)
    assert lost < 0.01 * (1 - p**pm.BAND_ROWS) ** pm.BANDS
