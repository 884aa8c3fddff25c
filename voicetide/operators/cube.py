"""One aggregation over the posts; every report derives from its few rows.

The cube has at most (brands x platforms x buckets x months) rows whatever the
number of posts.  Hash aggregation combines inside each map task, so a brand
or bucket that holds most posts still sends one row per task and key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voicetide.config import Calendar
from voicetide.functions.literals import grid

MEASURES = (
    "n", "complaints", "escalations", "negatives", "neutrals", "positives", "engagement_sum"
)


def feedback_cube(
    posts: DataFrame,
    keys: Sequence[str],
    calendar: Calendar | None = None,
    brands: Sequence[str] | None = None,
    calendar_only: bool = False,
) -> DataFrame:
    """Counts by ``keys``; ``month_idx`` is the position in ``calendar``.

    Posts outside the calendar have a null ``month_idx``; ``calendar_only``
    drops them with a range predicate the scan can use.
    """
    if brands is not None:
        posts = posts.filter(F.col("brand").isin(list(brands)))
    if calendar is not None:
        if calendar_only:
            posts = posts.filter(calendar.covers(F.col("date")))
        posts = posts.withColumn("month_idx", calendar.index_of(F.col("date")))
        if calendar_only:
            posts = posts.filter(F.col("month_idx").isNotNull())
    has = set(posts.columns)

    def count_of(column: str, condition) -> Any:
        return F.count_if(condition) if column in has else F.lit(0).cast("bigint")

    sentiment = F.col("sentiment")
    measures = {
        "n": F.count(F.lit(1)),
        "complaints": count_of("is_complaint", F.col("is_complaint")),
        "escalations": count_of("is_escalation", F.col("is_escalation")),
        "negatives": count_of("sentiment", sentiment == "Negative"),
        "neutrals": count_of("sentiment", sentiment == "Neutral"),
        "positives": count_of("sentiment", sentiment == "Positive"),
        "engagement_sum": F.sum("engagement") if "engagement" in has else F.lit(0).cast("bigint"),
    }
    return posts.groupBy(*keys).agg(*[c.alias(name) for name, c in measures.items()])


def roll_up(cube: DataFrame, *keys: str) -> DataFrame:
    """Sum the measures over the dropped keys."""
    measures = [m for m in MEASURES if m in cube.columns]
    return cube.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def dense_fill(cube: DataFrame, axes: Mapping[str, Sequence[Any]]) -> DataFrame:
    """Sum the cube over the given axes with a row for every combination.

    Zero rows for the grid are added before the sum, so filling costs no join.
    Values outside the axes keep their own rows.
    """
    zeros = grid(cube.sparkSession, **axes)
    for measure in MEASURES:
        if measure in cube.columns:
            zeros = zeros.withColumn(measure, F.lit(0).cast("bigint"))
    kept = cube.select(*zeros.columns)
    for axis in axes:
        zeros = zeros.withColumn(axis, F.col(axis).cast(kept.schema[axis].dataType))
    return roll_up(kept.unionByName(zeros), *axes)


def group_sizes(posts: DataFrame) -> DataFrame:
    """Counts by (brand, platform) and by (brand, bucket) in one pass.

    Grouping sets copy every input row once per set, so they run on the counts
    of the finest grouping instead of on the posts.
    """
    finest = posts.groupBy("brand", "platform", "bucket").agg(F.count(F.lit(1)).alias("n"))
    sets = [["brand", "platform"], ["brand", "bucket"]]
    return finest.groupingSets(sets, "brand", "platform", "bucket").agg(F.sum("n").alias("n"))


def source_mix(posts: DataFrame) -> DataFrame:
    """Total rows and rows by data source."""
    return posts.groupBy().agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("data_source") == "real").alias("real"),
        F.count_if(F.col("data_source") == "synthetic").alias("synthetic"),
    )
