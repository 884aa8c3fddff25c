"""Keep-first deduplication with an explicit meaning of "first"."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX_LENGTH = 200
RECORD_PREFIX = 100


def keep_first(rows: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank filter drops later copies inside every map task before the
    shuffle, so a key that holds a third of all rows sends at most one row per
    map task.  The window sorts on a 64-bit hash first; the keys themselves
    stay in the partitioning, so a hash collision cannot merge two keys.
    """
    named = {f"_k{i}": k for i, k in enumerate(keys)}
    window = Window.partitionBy("_h", *named).orderBy(*order)
    return (
        rows.withColumns(named)
        .withColumn("_h", F.xxhash64(*named))
        .withColumn("_rn", F.row_number().over(window))
        .filter(F.col("_rn") == 1)
        .drop("_h", "_rn", *named)
    )


def dedup_prefix(
    posts: DataFrame,
    scope: Sequence[str] = ("brand", "platform"),
    length: int = PREFIX_LENGTH,
) -> DataFrame:
    """Keep the earliest post per scope and leading text."""
    keys = [*[F.col(c) for c in scope], F.substring("text", 1, length)]
    order = [F.col("date").asc_nulls_last(), F.col("id"), F.col("text")]
    return keep_first(posts, keys, order)


def record_key(items: DataFrame, url: str = "url", item_id: str = "id") -> Column:
    """``url``, else ``id``, else the start of the record as JSON."""
    record = F.substring(F.to_json(F.struct(*items.columns)), 1, RECORD_PREFIX)
    return F.coalesce(
        F.nullif(F.col(url), F.lit("")), F.nullif(F.col(item_id).cast("string"), F.lit("")), record
    )


def dedup_key_chain(items: DataFrame, order: Sequence[Column]) -> DataFrame:
    return keep_first(items, [record_key(items)], order)
