import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voicetide.llm import toxicity as tx


def brute(scores):
    """All maximal scoring segments by the definition: the best one, then left and right of it."""
    best = None
    for a in range(len(scores)):
        for b in range(a, len(scores)):
            s = sum(scores[a : b + 1])
            if s > 0 and (best is None or (s, -(b - a)) > (best[2], -(best[1] - best[0]))):
                best = (a, b, s)
    if best is None:
        return []
    a, b, s = best
    left = brute(scores[:a])
    right = [(x + b + 1, y + b + 1, z) for x, y, z in brute(scores[b + 1 :])]
    return [*left, (a, b, s), *right]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([None, 1, 2, 5, 11]), max_size=24))
def test_segments_are_the_maximal_ones(values):
    gap = -1.37  # no sums of equal size, so the definition has no ties
    scores = [gap if v is None else v + 0.01 * i * 0.731 for i, v in enumerate(values)]
    found = tx.segments(np.array(scores, float))
    assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in brute(scores)]
    assert all(abs(s - sum(scores[a : b + 1])) < 1e-9 for a, b, s in found)


@pytest.fixture(scope="module")
def corpus(spark):
    rows, labels = [], []
    for i in range(400):
        text = " ".join(f"w{(i * 7 + k * k) % 90}" for k in range(60))
        bad = i % 4 == 0
        rows.append((i, f"{text} rotten, {text[:20]} Rotten! filth rotten" if bad else text, "en", "s", 1))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_told_apart(corpus):
    docs, labels = corpus
    for r in tx.judge(docs, labels).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.doc_id % 4 == 0) == int(r.score >= 0.5)
        assert 0 <= r.score <= 1 and bool(r.passages) == (r.doc_id % 4 == 0)


def test_labels_of_the_held_out_fold_are_not_read(corpus):
    docs, labels = corpus
    out = tx.held_out()
    flipped = labels.withColumn("toxic", tx.F.when(out, 1 - tx.F.col("toxic")).otherwise(tx.F.col("toxic")))
    assert tx.fit(docs, labels) == tx.fit(docs, flipped)


def held_out_recall(docs, labels):
    """Share of the held-out toxic rows that score above nine tenths of the clean ones."""
    known = labels.filter("toxic IS NOT NULL").groupBy("doc_id").agg(tx.F.max("toxic").alias("toxic"))
    found = tx.judge(docs, labels).filter("held_out").join(known, "doc_id").toPandas()
    clean, toxic = found[found.toxic == 0].score, found[found.toxic == 1].score
    return (toxic > clean.quantile(0.9)).mean(), (found[found.toxic == 0].predicted == 0).mean()


def test_recall_on_the_labelled_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    recall, left = held_out_recall(docs, labels)
    assert recall >= 0.9 and left >= 0.9


@pytest.mark.parametrize("n_suffixes", [1, 400])
def test_recall_where_every_form_of_a_word_is_rare(spark, n_suffixes):
    """Toxic words are a few stems with many endings, one in forty tokens, in prose of many words."""
    draw = random.Random(n_suffixes)
    words = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in ("a", "e", "io", "ou", "an") for c in ("ren", "tal", "sov", "mik", "dur", "")]
    ends = ["".join(draw.choices("aeioulnrst", k=3)) for _ in range(n_suffixes)]
    rows, labels = [], []
    for i in range(1500):
        tokens = [draw.choice(words) + draw.choice(["", "e", "en", "ung", ","]) for _ in range(draw.randint(60, 200))]
        if i % 10 == 0:
            for k in range(0, len(tokens), 40):
                tokens[k] = draw.choice(["vequo", "lowei", "chlla"]) + draw.choice(ends)
        rows.append((i, " ".join(tokens), "en", "s", 1))
        labels.append((i, 1, int(i % 10 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    recall, left = held_out_recall(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert recall >= 0.9 and left >= 0.95


def test_tokens_speak_for_and_against():
    model = tx.Model({"rotten": 3.0, "thanks": -2.0}, gap=-0.1)
    n, found = model.scan("well rotten rotten thanks thanks thanks rotten", tx.Scores(model))
    assert n == 7 and [(a, b) for a, b, _ in found] == [(1, 2), (6, 6)]


def test_cases(spark, corpus, edge, nothing):
    docs, labels = corpus
    odd = labels.union(spark.createDataFrame([(None, 1, 1), (77, 1, None), (4, 1, 0)], labels.schema))
    model = tx.fit(docs, odd)
    assert model.weights["rotten"] > 1
    rows = tx.score(edge, model, ["doc_id", "text"]).collect()
    assert len(rows) == edge.count() and all(r.score < 0.5 and r.passages == [] for r in rows)
    assert tx.judge(nothing, labels).count() == 0
    none = tx.judge(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.25, 0)}


def test_stage_keeps_columns_and_clean_rows(corpus, edge):
    docs, labels = corpus
    kept = tx.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(400) if i % 4]
    clean = tx.keep_clean(edge, labels)
    assert clean.columns == edge.columns and clean.count() == edge.count()


def test_a_long_text_with_one_marker_and_far_scores():
    model = tx.Model({"rotten": 900.0}, gap=-0.1)
    n, found = model.scan("rotten " + "w " * 20_000, tx.Scores(model))
    assert n == 20_001 and model.evidence(n, found) > 6
