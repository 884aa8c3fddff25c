"""Bag unions and priority merges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voicetide.operators.dedup import keep_first


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_missing(frames: Sequence[DataFrame]) -> DataFrame:
    """Union where a missing column becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_non_empty(
    frames: Sequence[DataFrame], key: str, order: Sequence[Column] = ()
) -> DataFrame:
    """Per key, the row of the first source that has the key.

    ``order`` decides among several rows of that source; it may be left out
    where a source has a key once.
    """
    tagged = [f.withColumn("_source", F.lit(i)) for i, f in enumerate(frames)]
    merged = union_missing(tagged)
    return keep_first(merged, [F.col(key)], [F.col("_source"), *order]).drop("_source")
