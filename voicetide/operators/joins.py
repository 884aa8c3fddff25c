"""Joins on post keys and on the taxonomy dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_topics(posts: DataFrame, topics: DataFrame, key: str = "id") -> DataFrame:
    """Left join of (key, topic_label) rows; posts without a topic get ``""``.

    ``topics`` has one row per key.  Both sides shuffle on the key unless the
    topics are small enough for a broadcast at run time.
    """
    named = topics.select(key, "topic_label")
    return posts.drop("topic_label").join(named, key, "left").withColumn(
        "topic_label", F.coalesce("topic_label", F.lit(""))
    )


def attach_labels(posts: DataFrame, taxonomy_dim: DataFrame) -> DataFrame:
    """Bucket labels from a taxonomy dimension; unknown buckets get null."""
    dim = taxonomy_dim.select("bucket", "bucket_label", "bucket_ord")
    return posts.drop("bucket_label", "bucket_ord").join(dim, "bucket", "left")
