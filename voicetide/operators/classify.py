"""Bucket, confidence, sentiment and flags, row by row and without Python."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voicetide import lexicons as lx
from voicetide.config import Taxonomy
from voicetide.functions import regexes as rx

_FOLDED = "_folded"


def _with_folded(posts: DataFrame, text: str) -> DataFrame:
    """The folded text as a column, so that all patterns share one folding."""
    return posts.withColumn(_FOLDED, rx.fold(F.col(text)))


def _classify(posts: DataFrame, taxonomy: Taxonomy, text: str) -> DataFrame:
    # The match array is computed once per row; the outer projections only
    # read it.  Labels are plan literals, so there is no join.
    matched = posts.withColumn(
        "_matched", rx.bucket_hits(F.col(text), F.col(_FOLDED), taxonomy)
    )
    picked = matched.withColumns(
        {
            "bucket": rx.best_bucket(F.col("_matched"), taxonomy),
            "confidence": rx.match_confidence(F.col("_matched")),
        }
    ).drop("_matched")
    return picked.withColumn("bucket_label", taxonomy.label_of(F.col("bucket")))


def _sentiment(posts: DataFrame, text: str, negative: str, positive: str) -> DataFrame:
    hits = [rx.count_hits(F.col(text), F.col(_FOLDED), words) for words in (negative, positive)]
    balanced = posts.withColumn("_balance", hits[0] - hits[1])
    return balanced.withColumn("sentiment", rx.sentiment_of(F.col("_balance"))).drop("_balance")


def _flags(posts: DataFrame, text: str, complaint: str, escalation: str) -> DataFrame:
    return posts.withColumns(
        {
            "is_complaint": rx.has_hit(F.col(text), F.col(_FOLDED), complaint),
            "is_escalation": rx.has_hit(F.col(text), F.col(_FOLDED), escalation),
        }
    )


def classify_posts(posts: DataFrame, taxonomy: Taxonomy, text: str = "text") -> DataFrame:
    """Add ``bucket``, ``bucket_label`` and ``confidence``."""
    return _classify(_with_folded(posts, text), taxonomy, text).drop(_FOLDED)


def add_sentiment(
    posts: DataFrame,
    text: str = "text",
    negative: str = lx.NEGATIVE_WORDS,
    positive: str = lx.POSITIVE_WORDS,
) -> DataFrame:
    return _sentiment(_with_folded(posts, text), text, negative, positive).drop(_FOLDED)


def add_flags(
    posts: DataFrame,
    text: str = "text",
    complaint: str = lx.COMPLAINT_WORDS,
    escalation: str = lx.ESCALATION_WORDS,
) -> DataFrame:
    return _flags(_with_folded(posts, text), text, complaint, escalation).drop(_FOLDED)


def label_posts(
    posts: DataFrame,
    taxonomy: Taxonomy,
    text: str = "text",
    negative: str = lx.NEGATIVE_WORDS,
    positive: str = lx.POSITIVE_WORDS,
    complaint: str = lx.COMPLAINT_WORDS,
    escalation: str = lx.ESCALATION_WORDS,
) -> DataFrame:
    """Bucket, sentiment and flags together, folding each text once."""
    folded = _with_folded(posts, text)
    bucketed = _classify(folded, taxonomy, text)
    felt = _sentiment(bucketed, text, negative, positive)
    return _flags(felt, text, complaint, escalation).drop(_FOLDED)
