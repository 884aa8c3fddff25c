"""Topics of the default bucket: TF-IDF over words and word pairs, then k-means (``clusters``).

Texts are tokenised once: their words are written to the shared folder, where
Parquet stores them as numbers into a dictionary of words, and counts, document
frequencies and vectors all read these.  Terms are counted inside tasks
(``term_counts``).  The only shuffles are the two term counts, which combine inside map
tasks; the second one is limited, without losing anything, to pairs of frequent
words.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voicetide.operators.clusters import Clusters, kmeans
from voicetide.operators.term_counts import document_frequencies, pairs_among, unit_vectors
from voicetide.session import importable, materialise

#: Runs of two or more letters, digits or underscores.
WORD = r"[\p{L}\p{N}_]{2,}"
MAX_FEATURES = 500
MIN_POSTS = 20
#: Frequent words that are shipped to the tasks; more of them (all tied) are joined.
MAX_SHIPPED = 20_000


def english_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def words(text: Column, stop_words: Sequence[str]) -> Column:
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))
    if not stop_words:
        return found
    return F.filter(found, lambda w: ~w.isin(list(stop_words)))


def _adjacent(tokens: Column) -> Column:
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, 1, pairs), F.slice(tokens, 2, pairs),
        lambda a, b: F.struct(a.alias("_a"), b.alias("_b")),
    )


def tokenised(
    docs: DataFrame, text: str, stop_words: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """The columns ``keep`` and ``_words``, written once and read by whoever counts."""
    return materialise(docs.select(*keep, words(F.col(text), stop_words).alias("_words")), "words")


def _exploded(docs: DataFrame, array: Column) -> DataFrame:
    """One row per element.

    For a plain explode Spark adds a filter on the array's size, which would
    tokenise each text twice; the outer form has no such filter.
    """
    return docs.select(F.explode_outer(array).alias("term")).filter(F.col("term").isNotNull())


def vocabulary(tokens: DataFrame, max_features: int = MAX_FEATURES) -> list[str]:
    """The most frequent words and pairs, ties in alphabetical order.

    A pair occurs at most as often as each of its words, so no pair with a
    word rarer than the ``max_features``-th word can make the list: only pairs of
    words at least that frequent are counted.  These few words are shipped to the
    tasks.  Where more than ``MAX_SHIPPED`` tie, all pairs are counted first, inside
    map tasks, and then joined with them.
    """
    words_of = _exploded(tokens, F.col("_words"))
    counted = materialise(
        words_of.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "word-counts"
    )
    singles = counted.orderBy(F.desc("n"), "term").limit(max_features).collect()
    floor = singles[-1]["n"] if len(singles) == max_features else 1
    frequent = counted.filter(F.col("n") >= floor).select("term")
    shipped = frequent.limit(MAX_SHIPPED + 1).collect()
    if not shipped:
        return []
    if len(shipped) <= MAX_SHIPPED:
        found = pairs_among(tokens, [r["term"] for r in shipped])
    else:
        every = tokens.select(F.explode_outer(_adjacent(F.col("_words"))).alias("_p")).select("_p.*")
        each = every.filter("_a IS NOT NULL").groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("n"))
        found = each.join(frequent.withColumnRenamed("term", "_a"), "_a", "left_semi").join(
            frequent.withColumnRenamed("term", "_b"), "_b", "left_semi"
        )
    pairs = (
        found.groupBy("_a", "_b")
        .agg(F.sum("n").alias("n"))
        .select(F.concat_ws(" ", "_a", "_b").alias("term"), "n")
        .orderBy(F.desc("n"), "term")
        .limit(max_features)
        .collect()
    )
    best = sorted([*singles, *pairs], key=lambda r: (-r["n"], r["term"]))
    return [r["term"] for r in best[:max_features]]


@dataclass
class TfIdf:
    """Fitted weighting: smooth inverse document frequency plus one, unit length."""

    stop_words: Sequence[str]
    terms: list[str]
    weights: np.ndarray

    def weigh(self, tokens: DataFrame) -> DataFrame:
        """``features`` from ``_words``."""
        importable(tokens.sparkSession)
        vectors = unit_vectors(self.terms, self.weights)
        return tokens.withColumn("features", vectors("_words")).drop("_words")

    def transform(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``features`` of texts, tokenised on the way: for texts that are read once."""
        return self.weigh(docs.withColumn("_words", words(F.col(text), self.stop_words)))


def fit_weights(
    tokens: DataFrame, stop_words: Sequence[str], max_features: int = MAX_FEATURES
) -> TfIdf | None:
    """Fit on tokenised documents; None when they hold no terms."""
    terms = vocabulary(tokens, max_features)
    if not terms:
        return None
    n, with_term = document_frequencies(tokens, terms)
    return TfIdf(stop_words, terms, np.log((n + 1.0) / (with_term + 1.0)) + 1.0)


def fit_transform(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] = (),
    stop_words: Sequence[str] | None = None,
    max_features: int = MAX_FEATURES,
) -> tuple[TfIdf | None, DataFrame]:
    """Fit on all documents and weigh them: the columns ``keep`` and ``features``.

    Every text is tokenised once.  Without any term there is no model, and the
    second value holds the tokens.
    """
    stop = english_stop_words() if stop_words is None else list(stop_words)
    tokens = tokenised(docs, text, stop, keep)
    model = fit_weights(tokens, stop, max_features)
    return model, tokens if model is None else model.weigh(tokens)


def fit_tfidf(
    docs: DataFrame,
    text: str = "text",
    stop_words: Sequence[str] | None = None,
    max_features: int = MAX_FEATURES,
) -> TfIdf | None:
    """Fit on all documents; None when they hold no terms."""
    return fit_transform(docs, text, (), stop_words, max_features)[0]


def tfidf_rows(model: TfIdf, docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row per document and term with a positive weight."""
    return weight_rows(model, model.transform(docs.select(key, text), text), key)


def weight_rows(model: TfIdf, vectors: DataFrame, key: str) -> DataFrame:
    """One row per document and term with a positive weight, from ``features``."""
    names = F.array(*[F.lit(t) for t in model.terms])
    parts = F.unwrap_udt("features")
    entry = F.explode(F.arrays_zip(parts["indices"].alias("i"), parts["values"].alias("w")))
    return (
        vectors.select(key, entry.alias("_e"))
        .filter(F.col("_e.w") > 0)
        .select(key, names[F.col("_e.i")].alias("term"), F.col("_e.w").alias("weight"))
    )


def cluster_terms(
    vectors: DataFrame, cluster: str, terms: Sequence[str], k: int = 3
) -> DataFrame:
    """Label per cluster: the terms with the largest mean weight, joined by ``_``.

    The mean vector per cluster is summed inside map tasks; only
    clusters x features rows remain for the ranking.
    """
    centres = vectors.groupBy(cluster).agg(Summarizer.mean(F.col("features")).alias("centre"))
    names = F.array(*[F.lit(t) for t in terms])
    rows = centres.select(
        cluster, F.posexplode_outer(vector_to_array("centre")).alias("_i", "mean_weight")
    ).select(cluster, names[F.col("_i")].alias("term"), F.bround("mean_weight", 9).alias("w"))
    order = Window.partitionBy(cluster).orderBy(F.desc("w"), "term")
    top = rows.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= k)
    listed = F.transform(
        F.sort_array(F.collect_list(F.struct("rn", "term"))), lambda s: s["term"]
    )
    return top.groupBy(cluster).agg(F.array_join(listed, "_").alias("topic_label"))


def topic_count(n_posts: int, n_topics: int = 10) -> int:
    return min(n_topics, n_posts // 5 + 1)


@dataclass
class TopicModel:
    weights: TfIdf
    clusters: Clusters
    labels: list[str]

    def label(self, posts: DataFrame, bucket: str, text: str = "text") -> DataFrame:
        """Add ``topic_label``; ``""`` outside the given bucket.

        Texts of other buckets are blanked instead of split off, so posts are
        read once and no join brings the labels back.
        """
        inside = F.col("bucket") == bucket
        masked = posts.withColumn(
            "_topic_text", F.when(inside, F.coalesce(text, F.lit(""))).otherwise("")
        )
        found = self.clusters.transform(self.weights.transform(masked, "_topic_text"))
        names = F.array(*[F.lit(x) for x in self.labels])
        label = F.when(inside, names[F.col("_cluster")]).otherwise(F.lit(""))
        return found.withColumn("topic_label", F.coalesce(label, F.lit(""))).drop(
            "_topic_text", "features", "_cluster"
        )


def fit_topic_vectors(
    docs: DataFrame,
    n_docs: int,
    text: str = "text",
    keep: Sequence[str] = (),
    n_topics: int = 10,
    seed: int = 42,
    stop_words: Sequence[str] | None = None,
    max_features: int = MAX_FEATURES,
) -> tuple[TopicModel | None, DataFrame]:
    """The model, and the columns ``keep`` and ``features`` of the documents it was fitted on.

    Vectors that the caller keeps are written once, for the clusters and for the caller.
    Without any term there is no model, and the second value holds the tokens.
    """
    weights, vectors = fit_transform(docs, text, keep, stop_words, max_features)
    if weights is None:
        return None, vectors
    if keep:
        vectors = materialise(vectors, "vectors")
    clusters = kmeans(vectors, topic_count(n_docs, n_topics), len(weights.terms), seed=seed)
    labels = []
    for centre in clusters.clusterCenters():
        best = sorted(zip(weights.terms, centre), key=lambda p: (-p[1], p[0]))
        labels.append("_".join(t for t, _ in best[:3]))
    return TopicModel(weights, clusters, labels), vectors


def fit_topics(
    docs: DataFrame,
    n_docs: int,
    text: str = "text",
    n_topics: int = 10,
    seed: int = 42,
    stop_words: Sequence[str] | None = None,
    max_features: int = MAX_FEATURES,
) -> TopicModel | None:
    return fit_topic_vectors(docs, n_docs, text, (), n_topics, seed, stop_words, max_features)[0]


def detect_topics(
    posts: DataFrame,
    default_bucket: str,
    text: str = "text",
    n_topics: int = 10,
    seed: int = 42,
    stop_words: Sequence[str] | None = None,
    min_posts: int = MIN_POSTS,
) -> DataFrame:
    """Add ``topic_label`` to the posts of the default bucket.

    Fewer than ``min_posts`` such posts give no topics; posts without any
    usable term all become ``misc``.
    """
    docs = posts.filter(F.col("bucket") == default_bucket).select(text)
    n_docs = docs.count()
    if n_docs < min_posts:
        return posts.withColumn("topic_label", F.lit(""))
    model = fit_topics(docs, n_docs, text, n_topics, seed, stop_words)
    if model is None:
        return posts.withColumn(
            "topic_label",
            F.when(F.col("bucket") == default_bucket, F.lit("misc")).otherwise(F.lit("")),
        )
    return model.label(posts, default_bucket, text)
