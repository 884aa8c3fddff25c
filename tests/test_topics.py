"""TF-IDF against brute force, guards and topic labels."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voicetide.operators import term_counts as tc
from voicetide.operators import topics as tp

WORDS = ["late", "rider", "cold", "soup", "refund", "app", "Crash", "été", "the", "of", "x", "a1"]
STOP = ("the", "of")


def texts(n=60, seed=5):
    rng = random.Random(seed)
    return [" ".join(rng.choices(WORDS, k=rng.randrange(0, 25))) for _ in range(n)]


def terms_of(text):
    tokens = [w for w in re.findall(r"\w\w+", text.lower()) if w not in STOP]
    return tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]


def brute_force(docs, limit):
    total = Counter(t for d in docs for t in terms_of(d))
    vocab = sorted(total, key=lambda t: (-total[t], t))[:limit]
    df = Counter(t for d in docs for t in set(terms_of(d)) if t in vocab)
    out = {}
    for i, d in enumerate(docs):
        tf = Counter(t for t in terms_of(d) if t in vocab)
        weights = {t: n * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, n in tf.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        out.update({(i, t): w / norm for t, w in weights.items()})
    return vocab, out


@pytest.mark.parametrize("limit", [5, 20, 500])
def test_tfidf(spark, limit):
    docs = texts()
    rows = spark.createDataFrame(list(enumerate(docs)), "i int, text string").repartition(3)
    vocab, want = brute_force(docs, limit)
    model = tp.fit_tfidf(rows, stop_words=STOP, max_features=limit)
    assert model.terms == vocab
    got = {(r.i, r.term): r.weight for r in tp.tfidf_rows(model, rows, "i").collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_vocabulary_with_many_ties_counts_all_pairs(spark):
    # Every word occurs once, far more than the probe holds: no pair may be lost.
    docs = [f"w{i:03d} v{i:03d}" for i in range(200)] + ["zz zz zz zz"]
    rows = spark.createDataFrame(list(enumerate(docs)), "i int, text string")
    assert tp.vocabulary(tp.tokenised(rows, "text", ()), 10) == brute_force(docs, 10)[0]


def test_pairs_are_counted_in_tasks(spark, monkeypatch):
    # exploded and joined, the pairs of a hot word are one task's work
    rows = spark.createDataFrame(list(enumerate(texts())), "i int, text string").repartition(3)
    tokens, want = tp.tokenised(rows, "text", STOP), brute_force(texts(), 20)[0]

    def exploded(_):
        raise AssertionError("one row a pair")

    with monkeypatch.context() as m:
        m.setattr(tp, "_adjacent", exploded)
        assert tp.vocabulary(tokens, 20) == want
    # more tied words than are shipped
    monkeypatch.setattr(tp, "MAX_SHIPPED", 3)
    assert tp.vocabulary(tokens, 20) == want


def test_terms_of_slices_nulls_and_text_ends():
    words = pa.array([["x"], ["a", "b"], None, ["c"], [], ["a", "x", "b", "c", "a", "b"]] * 700)
    found = {}
    for first, (n, text, term, count) in enumerate(tc.TermCounter(["a", "b c", "b", "c a", "a b"]).counts(words[1:])):
        assert n <= tc.ROWS
        found |= {(first * tc.ROWS + i, t): c for i, t, c in zip(text.tolist(), term.tolist(), count.tolist())}
    # "b" at a text's end and "c" at the next one's start are no pair
    one = {0: {0: 1, 2: 1, 4: 1}, 4: {0: 2, 1: 1, 2: 2, 3: 1, 4: 1}}
    want = {(6 * k + i, t): c for k in range(700) for i, each in one.items() for t, c in each.items()}
    assert found == want


def test_pairs_of_a_batch_are_counted_in_slices(monkeypatch):
    sizes, whole = [], tc.known_words
    monkeypatch.setattr(tc, "known_words", lambda words, among: (sizes.append(len(words)), whole(words, among))[1])
    words = pa.array([["a", "b", "a"], ["b"], None, ["a", "x", "b"]] * 700, pa.list_(pa.string()))
    pairs, n = tc.pair_counts(words, pa.array(["a", "b"]))
    assert dict(zip(pairs.tolist(), n.tolist())) == {1: 700, 2: 700}
    assert sum(sizes) == 2800 and max(sizes) <= tc.ROWS
    assert [len(x) for x in tc.pair_counts(words[:0], pa.array(["a"]))] == [0, 0]


def test_texts_are_tokenised_once(spark):
    rows = spark.createDataFrame(list(enumerate(texts())), "i int, text string")
    model, vectors = tp.fit_transform(rows, keep=["i"], stop_words=STOP, max_features=20)
    # neither the vectors nor the counts go back to the texts
    plan = vectors._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "_words" in plan
    once = {(r.i, r.term): r.weight for r in tp.weight_rows(model, vectors, "i").collect()}
    again = {(r.i, r.term): r.weight for r in tp.tfidf_rows(model, rows, "i").collect()}
    assert once == again and once


def test_vectors_are_stored_for_clusters_and_caller(spark):
    rows = spark.createDataFrame(list(enumerate(texts())), "i int, text string")
    model, vectors = tp.fit_topic_vectors(rows, 60, keep=["i"], n_topics=3, stop_words=STOP, max_features=20)
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "_words" not in plan
    stored = {(r.i, r.term): r.weight for r in tp.weight_rows(model.weights, vectors, "i").collect()}
    again = {(r.i, r.term): r.weight for r in tp.tfidf_rows(model.weights, rows, "i").collect()}
    assert stored == again and stored


def test_nothing_to_fit(spark):
    for rows in ([], [(1, None), (2, "!"), (3, "")]):
        docs = spark.createDataFrame(rows, "i int, text string")
        model, tokens = tp.fit_transform(docs, keep=["i"])
        assert model is None and tokens.count() == len(rows) and tp.fit_topics(docs, len(rows)) is None


def classified(spark, n_other):
    rows = [(str(i), t, "I_Other") for i, t in enumerate(texts(n_other, 9))]
    rows += [(f"d{i}", "late late", "D_Delay") for i in range(5)]
    rows += [("none", None, "I_Other")]
    return spark.createDataFrame(rows, "id string, text string, bucket string")


def test_guard(spark):
    got = tp.detect_topics(classified(spark, 18), "I_Other")
    assert {r.topic_label for r in got.collect()} == {""}


def test_topics_only_in_the_default_bucket(spark):
    posts = classified(spark, 80)
    got = tp.detect_topics(posts, "I_Other", n_topics=4)
    assert got.columns == ["id", "text", "bucket", "topic_label"]
    rows = got.collect()
    assert len(rows) == 86
    assert {r.topic_label for r in rows if r.bucket != "I_Other"} == {""}
    labels = {r.topic_label for r in rows if r.bucket == "I_Other"}
    assert "" not in labels and 1 < len(labels) <= 4
    assert all(len(x.split("_")) == 3 for x in labels)


def test_posts_without_terms_are_misc(spark):
    rows = spark.createDataFrame([(str(i), "x !", "I_Other") for i in range(25)],
                                 "id string, text string, bucket string")
    got = tp.detect_topics(rows, "I_Other").select("topic_label").distinct().collect()
    assert [r[0] for r in got] == ["misc"]


def test_clusters_are_the_nearest_centres(spark):
    rng = random.Random(2)
    halves = [("late", "rider", "delay"), ("soup", "cold", "taste")]
    docs = [(i, " ".join(rng.choices(halves[i % 2], k=8))) for i in range(60)]
    rows = spark.createDataFrame(docs, "i int, text string")
    model = tp.fit_topics(rows, len(docs), n_topics=2)
    centres = model.clusters.clusterCenters()
    assert len(centres) == 2 and len(model.labels) == 2
    for row in model.clusters.transform(model.weights.transform(rows)).collect():
        away = [sum((a - b) ** 2 for a, b in zip(row.features.toArray(), c)) for c in centres]
        assert row._cluster == away.index(min(away))


def test_topic_count():
    assert [tp.topic_count(n) for n in (20, 25, 45, 1000)] == [5, 6, 10, 10]


def test_cluster_terms(spark):
    docs = [("a", "late late rider"), ("a", "late"), ("b", "soup cold"), ("b", "soup")]
    rows = spark.createDataFrame(docs, "c string, text string")
    model = tp.fit_tfidf(rows, stop_words=STOP)
    got = tp.cluster_terms(model.transform(rows), "c", model.terms, 2).orderBy("c").collect()
    assert [r.topic_label.split("_")[0] for r in got] == ["late", "soup"]


def test_words_are_unicode(spark):
    rows = spark.createDataFrame([("Été à l'Île_2 x",), (None,)], "t string")
    got = [r[0] for r in rows.select(tp.words(F.col("t"), ())).collect()]
    assert got == [["été", "île_2"], []]
