"""Regex functions against Python's re module."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voicetide import lexicons as lx
from voicetide.functions import regexes as rx
from voicetide.operators.classify import add_flags, add_sentiment, classify_posts, label_posts

TX = lx.default_taxonomy(["Acme"])
LEXICONS = ["|".join(b.patterns) for b in TX.buckets] + [
    lx.NEGATIVE_WORDS, lx.POSITIVE_WORDS, lx.COMPLAINT_WORDS, lx.ESCALATION_WORDS,
]
PIECES = sorted({
    re.sub(r"[?()|].*", "", p) for lexicon in LEXICONS for p in lexicon.split("|")
} | {"cancelled", "no response", "veg and non veg", "days later still", "acme ai", "ſtale", "KING",
     "İnsect", "ınsect", "\n", "\r", " ", "é", " ", "ETA", "non\u0085veg"})


def model(text):
    """The classifier in plain Python."""
    if text is None or not text.strip():
        return TX.default.key, 0.5
    hits = {}
    for bucket in TX.buckets:
        found = re.findall("|".join(bucket.patterns), text, re.IGNORECASE)
        if found:
            hits[bucket.key] = len(found)
    if not hits:
        return TX.default.key, 0.5
    best = max(hits.values())
    first = next(k for k in TX.keys if hits.get(k) == best)
    return first, 1.0 if len(hits) == 1 else 0.8


def counts(text, pattern):
    return len(re.findall(pattern, text or "", re.IGNORECASE))


@settings(max_examples=12, deadline=None)
@given(st.lists(
    st.one_of(st.none(), st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=4)),
                                  max_size=8).map("".join)),
    min_size=30, max_size=60,
))
def test_against_python(spark, texts):
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    text = F.col("text")
    hits = [rx.count_hits(text, rx.fold(text), p).alias(f"h{n}") for n, p in enumerate(LEXICONS)]
    for row in rows.select("i", *hits).collect():
        expected = [counts(texts[row.i], p) for p in LEXICONS]
        assert [row[f"h{n}"] for n in range(len(LEXICONS))] == expected, texts[row.i]
    for row in label_posts(rows, TX).collect():
        value = texts[row.i]
        assert (row.bucket, row.confidence) == model(value), value
        neg, pos = counts(value, lx.NEGATIVE_WORDS), counts(value, lx.POSITIVE_WORDS)
        wanted = "Negative" if neg > pos else "Positive" if pos > neg else "Neutral"
        assert row.sentiment == wanted, value
        assert row.is_complaint == bool(counts(value, lx.COMPLAINT_WORDS))
        assert row.is_escalation == bool(counts(value, lx.ESCALATION_WORDS))


@pytest.mark.parametrize("text, bucket, confidence", [
    (None, "I_Other", 0.5),
    ("   ", "I_Other", 0.5),
    ("lovely evening", "I_Other", 0.5),
    ("order cancelled", "A_Cancellation", 1.0),
    # One hit each: the earlier bucket wins, also against a later one.
    ("refund for cold food", "E_Food_Quality", 0.8),
    # More hits beat the earlier bucket.
    ("cancelled, refund, cashback", "G_Payment_Coupon", 0.8),
    ("Acme AI is rude", "B_AI_Bot", 1.0),
])
def test_classify_cases(spark, text, bucket, confidence):
    rows = spark.createDataFrame([(text,)], "text string")
    row = classify_posts(rows, TX).first()
    assert (row.bucket, row.confidence) == (bucket, confidence)
    assert row.bucket_label == dict(zip(TX.keys, TX.labels))[bucket]


def test_flags_have_no_word_boundary(spark):
    rows = spark.createDataFrame([("a badge",), (None,), ("thanks",)], "text string")
    assert [r.is_complaint for r in add_flags(rows).collect()] == [True, False, False]
    assert [r.sentiment for r in add_sentiment(rows).collect()] == [
        "Negative", "Neutral", "Positive"]


def test_patterns_that_cannot_be_folded(spark):
    assert not rx.Lexicon.of(r"\bbad\b").folded
    assert not rx.Lexicon.of("café").folded
    assert rx.Lexicon.of("eta|b?ad").regex.startswith("(?id)(?:")
    rows = spark.createDataFrame([("BAD CAFÉ badge",)], "text string")
    text = F.col("text")
    row = rows.select(
        rx.count_hits(text, rx.fold(text), r"\bbad\b").alias("a"),
        rx.count_hits(text, rx.fold(text), "café").alias("b"),
    ).first()
    assert tuple(row) == (1, 1)


def test_taxonomy_round_trip(spark):
    from voicetide.config import Taxonomy

    again = Taxonomy.from_df(TX.to_df(spark))
    assert again.keys == TX.keys and again.labels == TX.labels
    assert again.buckets[0].patterns == ("|".join(TX.buckets[0].patterns),)


def test_result_does_not_depend_on_partitions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    one, many = (
        sorted(label_posts(docs.repartition(n), TX).drop("text").collect()) for n in (1, 13)
    )
    assert one == many


def test_texts_without_any_match_are_not_counted(spark):
    # one search over all lexicons decides; it must find what any of the counts would
    tx = lx.default_taxonomy(["acme", "globex"])
    texts = [p.replace(".", "-").replace("?", "") for b in tx.buckets for p in b.patterns if "(" not in p]
    texts = [f"x{t.upper()}" for t in texts] + [t.replace("k", "\u212a").replace("s", "\u017f") for t in texts]
    texts += [t[:-1] for t in texts] + ["", None, "nothing of it", "\u0130\u0131"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    text, folded = F.col("text"), rx.fold(F.col("text"))
    counts = [rx.count_hits(text, folded, b.patterns).alias(b.key) for b in tx.buckets]
    got = rows.select("text", rx.bucket_hits(text, folded, tx).alias("found"), *counts)
    several = 0
    for r in got.collect():
        want = {b.key: r[b.key] for b in tx.buckets if r[b.key]}
        assert {m.bucket: m.hits for m in r.found} == want, r.text
        several += bool(want)
    assert len(texts) // 4 < several < len(texts)
    assert "CASE WHEN coalesce(RLIKE(" in got._jdf.queryExecution().executedPlan().toString()
