"""Brand against brand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voicetide.config import Calendar, Taxonomy
from voicetide.functions import scalars as sc
from voicetide.operators.cube import dense_fill
from voicetide.operators.filters import gap_significance


def brand_pair(cube: DataFrame, a: str, b: str, taxonomy: Taxonomy) -> DataFrame:
    """Counts of both brands per bucket, dense, side by side."""
    pair = dense_fill(
        cube.filter(F.col("brand").isin(a, b)), {"brand": [a, b], "bucket": taxonomy.keys}
    )

    def count_of(brand: str):
        return F.sum(F.when(F.col("brand") == brand, F.col("n")).otherwise(0))

    return pair.groupBy("bucket").agg(count_of(a).alias("a_count"), count_of(b).alias("b_count"))


def competitive_gap(cube: DataFrame, a: str, b: str, taxonomy: Taxonomy) -> DataFrame:
    """Counts, shares of each brand's posts and the gap in percentage points.

    The gap subtracts the rounded shares; a positive gap is worse for ``a``.
    """
    everything = Window.partitionBy()
    pair = brand_pair(cube, a, b, taxonomy)
    totals = pair.withColumns(
        {
            "a_total": F.greatest(F.sum("a_count").over(everything), F.lit(1)),
            "b_total": F.greatest(F.sum("b_count").over(everything), F.lit(1)),
        }
    )
    return (
        totals.select(
            "bucket",
            taxonomy.label_of(F.col("bucket")).alias("bucket_label"),
            taxonomy.order_of(F.col("bucket")).alias("bucket_ord"),
            "a_count",
            "b_count",
            sc.share_pct(F.col("a_count"), F.col("a_total")).alias("a_share"),
            sc.share_pct(F.col("b_count"), F.col("b_total")).alias("b_share"),
        )
        .filter(F.col("bucket_ord").isNotNull())
        .withColumn("diff_share", F.bround(F.col("a_share") - F.col("b_share"), 1))
    )


def gap_list_columns(points: float = 2) -> list[Column]:
    """Aggregates: labels where ``a`` (``b``) is significantly higher, in bucket order."""
    side = gap_significance(F.col("diff_share"), points)

    def labels(which: str) -> Column:
        found = F.collect_list(F.when(side == which, F.struct("bucket_ord", "bucket_label")))
        return F.transform(F.sort_array(found), lambda s: s["bucket_label"])

    return [labels("higher").alias("higher_a"), labels("lower").alias("higher_b")]


def gap_lists(gaps: DataFrame, points: float = 2) -> DataFrame:
    return gaps.agg(*gap_list_columns(points))


def sorted_gap(gaps: DataFrame) -> DataFrame:
    return gaps.orderBy(F.desc("diff_share"), "bucket")


def chart_scale(gaps: DataFrame, margin: float = 5, default: float = 30) -> DataFrame:
    """Upper end of a share axis for both brands."""
    top = F.greatest(F.max("a_share"), F.max("b_share")) + F.lit(float(margin))
    return gaps.agg(F.coalesce(top, F.lit(float(default))).alias("max_val"))


def brand_differential(kpis: DataFrame, a: str, b: str) -> DataFrame:
    """Complaints of ``a`` relative to ``b`` as a signed percent label."""

    def complaints(brand: str):
        return F.sum(F.when(F.col("brand") == brand, F.col("complaint_posts")).otherwise(0))

    return kpis.agg(complaints(a).alias("a_complaints"), complaints(b).alias("b_complaints")).select(
        "a_complaints",
        "b_complaints",
        sc.signed_pct_label(F.col("b_complaints"), F.col("a_complaints")).alias("differential"),
    )


def bucket_deep_dive(
    gaps: DataFrame, trend: DataFrame, plan: DataFrame, brand: str, calendar: Calendar
) -> DataFrame:
    """Bucket metrics with their action-plan entry.

    Buckets without an entry are skipped.  All sides have one row per bucket,
    so the planner broadcasts by size without a hint.
    """
    months = trend.filter(F.col("brand") == brand).select("bucket_label", *calendar.names)
    joined = gaps.join(plan, "bucket_label", "inner").join(months, "bucket_label", "left")
    return joined.orderBy(F.desc("a_count"), "bucket_ord")
