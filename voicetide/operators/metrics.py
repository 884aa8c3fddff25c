"""Per-brand reports.  Every function takes a cube, never the posts.

Windows here run over a dense cube, a few hundred rows fixed by the number of
brands, buckets and months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voicetide.config import Calendar, Taxonomy
from voicetide.functions import scalars as sc
from voicetide.operators.cube import dense_fill, roll_up


def _of(cube: DataFrame, brands: Sequence[str]) -> DataFrame:
    """The rows of the listed brands; a report shows no others."""
    return cube.filter(F.col("brand").isin(list(brands)))


def _with_month(rows: DataFrame, calendar: Calendar) -> DataFrame:
    return rows.withColumn("month", calendar.name_of(F.col("month_idx")))


def platform_counts(cube: DataFrame) -> DataFrame:
    return roll_up(cube, "brand", "platform").select("brand", "platform", "n")


def overall_kpis(cube: DataFrame, brands: Sequence[str]) -> DataFrame:
    return dense_fill(_of(cube, brands), {"brand": brands}).select(
        "brand",
        F.col("n").alias("total_posts"),
        F.col("complaints").alias("complaint_posts"),
        F.col("escalations").alias("escalation_posts"),
        F.col("negatives").alias("negative_posts"),
    )


def kpi_rates(cube: DataFrame, brands: Sequence[str], platforms: Sequence[str]) -> DataFrame:
    """Complaint and escalation rates, mean engagement, posts by platform."""
    rows = dense_fill(_of(cube, brands), {"brand": brands, "platform": platforms})
    by_platform = [
        F.sum(F.when(F.col("platform") == p, F.col("n")).otherwise(0)).alias(p) for p in platforms
    ]
    total = F.col("total_posts")
    return (
        rows.groupBy("brand")
        .agg(
            F.sum("n").alias("total_posts"),
            F.sum("complaints").alias("complaints"),
            F.sum("escalations").alias("escalations"),
            F.sum("engagement_sum").alias("engagement_sum"),
            *by_platform,
        )
        .select(
            "brand",
            "total_posts",
            sc.share_pct(F.col("complaints"), total).alias("complaint_rate"),
            sc.share_pct(F.col("escalations"), total).alias("escalation_rate"),
            F.coalesce(
                F.bround(F.try_divide(F.col("engagement_sum"), total), 1), F.lit(0.0)
            ).alias("avg_engagement"),
            *[F.col(f"`{p}`") for p in platforms],
        )
    )


def negative_share(cube: DataFrame, brands: Sequence[str]) -> DataFrame:
    return dense_fill(_of(cube, brands), {"brand": brands}).select(
        "brand",
        F.col("negatives").alias("negative_posts"),
        sc.share_pct(F.col("negatives"), F.greatest("n", F.lit(1))).alias("negative_pct"),
    )


def monthly_totals(cube: DataFrame, brands: Sequence[str], calendar: Calendar) -> DataFrame:
    """Totals per brand and calendar month with the previous month's total."""
    months = _of(cube, brands).filter(F.col("month_idx").isNotNull())
    dense = dense_fill(months, {"brand": brands, "month_idx": range(len(calendar))})
    by_month = Window.partitionBy("brand").orderBy("month_idx")
    prev = F.lag("n").over(by_month)
    return _with_month(
        dense.select(
            "brand",
            "month_idx",
            F.col("n").alias("total"),
            "complaints",
            "escalations",
            F.col("negatives").alias("sentiment_neg"),
            prev.alias("prev_total"),
            sc.growth_pct(prev, F.col("n")).alias("mom_total_pct"),
        ),
        calendar,
    )


def growth_variants(totals: DataFrame) -> DataFrame:
    """The three growth formulas side by side: null base, ``N/A``, clamped base."""
    prev, cur = F.col("prev_total"), F.col("total")
    clamped = sc.growth_pct(prev, cur, zero_base="clamp")
    return totals.filter(prev.isNotNull()).select(
        "brand",
        "month",
        "total",
        sc.growth_pct(prev, cur).alias("growth_or_null"),
        sc.signed_pct_label(prev, cur).alias("growth_or_na"),
        F.concat(
            F.when(cur >= prev, F.lit("+")).otherwise(F.lit("")),
            clamped.cast("decimal(20,1)").cast("string"),
            F.lit("%"),
        ).alias("growth_clamped"),
    )


def monthly_buckets(
    cube: DataFrame, brands: Sequence[str], taxonomy: Taxonomy, calendar: Calendar
) -> DataFrame:
    """Dense counts per brand, month and bucket with share and previous count."""
    months = _of(cube, brands).filter(F.col("month_idx").isNotNull())
    dense = dense_fill(
        months,
        {"brand": brands, "bucket": taxonomy.keys, "month_idx": range(len(calendar))},
    )
    total = F.sum("n").over(Window.partitionBy("brand", "month_idx"))
    prev = F.lag("n").over(Window.partitionBy("brand", "bucket").orderBy("month_idx"))
    return _with_month(
        dense.select("brand", "bucket", "month_idx", "n", total.alias("month_total"),
                     prev.alias("prev_n")).select(
            "*",
            taxonomy.label_of(F.col("bucket")).alias("bucket_label"),
            sc.share_pct(F.col("n"), F.col("month_total")).alias("bucket_pct"),
            # The first month and a bucket absent last month have no growth.
            sc.growth_pct(
                F.coalesce("prev_n", F.lit(0)), F.col("n")
            ).alias("mom_bucket_pct"),
        ),
        calendar,
    )


def present_only(monthly: DataFrame) -> DataFrame:
    """Buckets with posts in the month; one that fell to zero is left out."""
    return monthly.filter(F.col("n") > 0)


def present_months(
    totals: DataFrame, calendar: Calendar, fallback: tuple[int, int]
) -> DataFrame:
    """Last two months with posts of any brand; ``fallback`` if fewer than two."""
    present = F.sort_array(F.collect_set(F.when(F.col("total") > 0, F.col("month_idx"))))
    enough = F.size("present") >= 2
    return totals.agg(present.alias("present")).select(
        F.transform("present", lambda i: calendar.name_of(i)).alias("present_months"),
        F.when(enough, F.try_element_at("present", F.lit(-2)))
        .otherwise(F.lit(fallback[0])).alias("prev_idx"),
        F.when(enough, F.try_element_at("present", F.lit(-1)))
        .otherwise(F.lit(fallback[1])).alias("last_idx"),
    )


def first_last_period(totals: DataFrame, calendar: Calendar) -> DataFrame:
    """First and last month with posts, per brand."""
    seen = totals.filter(F.col("total") > 0)
    return seen.groupBy("brand").agg(
        F.min_by("month", "month_idx").alias("first_month"),
        F.max_by("month", "month_idx").alias("last_month"),
        F.min_by("total", "month_idx").alias("first_total"),
        F.max_by("total", "month_idx").alias("last_total"),
    )


def first_last_change(
    monthly: DataFrame, first_idx: int = 0, fallback_last_idx: int = 2
) -> DataFrame:
    """Per brand and bucket: count in the first month against the brand's last
    month with posts, for buckets seen in either."""
    last = F.coalesce(
        F.max(F.when(F.col("month_total") > 0, F.col("month_idx"))).over(
            Window.partitionBy("brand")
        ),
        F.lit(fallback_last_idx),
    )
    marked = monthly.withColumn("_last", last)
    idx = F.col("month_idx")
    return (
        marked.groupBy("brand", "bucket", "bucket_label")
        .agg(
            F.sum(F.when(idx == first_idx, F.col("n")).otherwise(0)).alias("first_n"),
            F.sum(F.when(idx == F.col("_last"), F.col("n")).otherwise(0)).alias("last_n"),
        )
        .filter((F.col("first_n") > 0) | (F.col("last_n") > 0))
        .withColumn("change", F.col("last_n") - F.col("first_n"))
    )


def biggest_movers(changes: DataFrame) -> DataFrame:
    """Bucket with the largest rise and the largest fall; ties by label."""
    up = F.struct((-F.col("change")).alias("c"), "bucket_label")
    down = F.struct("change", "bucket_label")
    return changes.groupBy("brand").agg(
        F.min_by("bucket_label", up).alias("biggest_increase"),
        F.min_by("bucket_label", down).alias("biggest_decrease"),
    )


def bucket_shares(cube: DataFrame, brands: Sequence[str], taxonomy: Taxonomy) -> DataFrame:
    """Count and share of all the brand's posts per bucket, dense."""
    dense = dense_fill(_of(cube, brands), {"brand": brands, "bucket": taxonomy.keys})
    total = F.sum("n").over(Window.partitionBy("brand"))
    return (
        dense.select("brand", "bucket", "n", total.alias("brand_total"))
        .select(
            "brand",
            "bucket",
            taxonomy.label_of(F.col("bucket")).alias("bucket_label"),
            taxonomy.order_of(F.col("bucket")).alias("bucket_ord"),
            F.col("n").alias("count"),
            sc.share_pct(F.col("n"), F.col("brand_total")).alias("share"),
        )
        .filter(F.col("bucket_ord").isNotNull())
    )


def bucket_trend(monthly: DataFrame, calendar: Calendar) -> DataFrame:
    """Months as columns."""
    return (
        monthly.groupBy("brand", "bucket", "bucket_label")
        .pivot("month", calendar.names)
        .agg(F.sum("n"))
        .na.fill(0)
    )


def top_buckets(shares: DataFrame, k: int = 3) -> DataFrame:
    """Largest buckets per brand, ties in bucket order."""
    order = Window.partitionBy("brand").orderBy(F.desc("count"), "bucket_ord")
    return shares.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= k)


def top_bucket_by_month(monthly: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """Largest bucket per brand and month that has posts; ties in bucket order."""
    best = F.struct(F.col("n"), (-taxonomy.order_of(F.col("bucket"))).alias("o"))
    return (
        present_only(monthly)
        .groupBy("brand", "month_idx", "month")
        .agg(F.max_by("bucket_label", best).alias("top_bucket"), F.max("n").alias("n"))
    )


def trend_direction(totals: DataFrame, first_idx: int, last_idx: int) -> DataFrame:
    """First against last month: totals, absolute change and direction."""
    idx = F.col("month_idx")
    return (
        totals.groupBy("brand")
        .agg(
            F.sum(F.when(idx == first_idx, F.col("total")).otherwise(0)).alias("first_total"),
            F.sum(F.when(idx == last_idx, F.col("total")).otherwise(0)).alias("last_total"),
        )
        .withColumn("delta", F.col("last_total") - F.col("first_total"))
        .withColumn(
            "direction",
            F.when(F.col("delta") >= 0, F.lit("increasing")).otherwise(F.lit("declining")),
        )
    )


def sentiment_distribution(cube: DataFrame, brands: Sequence[str]) -> DataFrame:
    """Sentiment counts per brand; absent sentiments are left out."""
    rows = roll_up(_of(cube, brands), "brand")
    named = [("Negative", "negatives"), ("Neutral", "neutrals"), ("Positive", "positives")]
    pairs = F.array(
        *[F.struct(F.lit(s).alias("sentiment"), F.col(m).alias("n")) for s, m in named]
    )
    return rows.select("brand", F.inline(pairs)).filter(F.col("n") > 0)


def sentiment_share(cube: DataFrame, brands: Sequence[str]) -> DataFrame:
    dense = dense_fill(_of(cube, brands), {"brand": brands})
    total = F.col("negatives") + F.col("neutrals") + F.col("positives")
    return dense.select(
        "brand",
        "negatives",
        sc.share_pct(F.col("negatives"), total).alias("negative_pct"),
        "neutrals",
        sc.share_pct(F.col("neutrals"), total).alias("neutral_pct"),
        "positives",
        sc.share_pct(F.col("positives"), total).alias("positive_pct"),
    )
