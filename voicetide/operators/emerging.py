"""Fast-growing topics and month-over-month spikes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voicetide.config import Calendar
from voicetide.functions import scalars as sc
from voicetide.operators.filters import is_spike, non_empty_topic
from voicetide.operators.topn import top_n

SAMPLE = "array<struct<text:string,platform:string,date:string,engagement:bigint>>"


def topic_growth(
    posts: DataFrame,
    default_bucket: str,
    calendar: Calendar,
    first_idx: int = 0,
    last_idx: int = 2,
    k: int = 5,
) -> DataFrame:
    """Most frequent topics of the default bucket and their growth."""
    topics = non_empty_topic(posts.filter(F.col("bucket") == default_bucket))
    idx = calendar.index_of(F.col("date"))
    return (
        topics.groupBy("topic_label")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(idx == first_idx).alias("first_count"),
            F.count_if(idx == last_idx).alias("last_count"),
        )
        .orderBy(F.desc("total"), "topic_label")
        .limit(k)
        .withColumn("growth_pct", sc.growth_pct(F.col("first_count"), F.col("last_count")))
    )


def topic_samples(
    posts: DataFrame, topics: DataFrame, default_bucket: str, n: int = 3
) -> DataFrame:
    """Most engaging posts per listed topic, ties by id.

    ``topics`` is the result of a top-k, so its broadcast is bounded by k.
    """
    wanted = F.broadcast(topics.select("topic_label"))
    rows = posts.filter(F.col("bucket") == default_bucket).join(wanted, "topic_label", "left_semi")
    return top_n(
        rows.select("topic_label", "id", "text", "platform", "date", "engagement"),
        ["topic_label"],
        [F.desc("engagement"), F.asc("id")],
        n,
    )


def sample_lists(samples: DataFrame) -> DataFrame:
    """One ordered array of samples per topic (at most n of them)."""
    entry = F.struct(
        "rn",
        F.struct(
            "text", "platform", sc.second_label(F.col("date")).alias("date"), "engagement"
        ).alias("post"),
    )
    listed = F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["post"])
    return samples.groupBy("topic_label").agg(listed.cast(SAMPLE).alias("samples"))


def spikes(
    monthly: DataFrame,
    fallback: tuple[int, int] = (1, 2),
    first_idx: int = 0,
    min_growth: float = 50,
    min_count: int = 5,
) -> DataFrame:
    """Brand x bucket pairs that grew between the last two months with posts.

    ``monthly`` is the dense monthly cube, so the window over all of it sees a
    number of rows fixed by brands, buckets and months.
    """
    idx = F.col("month_idx")
    seen = F.sort_array(
        F.collect_set(F.when(F.col("n") > 0, idx)).over(Window.partitionBy())
    )
    marked = monthly.withColumn("_seen", seen)
    enough = F.size("_seen") >= 2
    prev = F.when(enough, F.try_element_at("_seen", F.lit(-2))).otherwise(F.lit(fallback[0]))
    last = F.when(enough, F.try_element_at("_seen", F.lit(-1))).otherwise(F.lit(fallback[1]))
    counts = marked.withColumns({"_prev": prev, "_last": last}).groupBy(
        "brand", "bucket", "bucket_label"
    ).agg(
        F.sum(F.when(idx == first_idx, F.col("n")).otherwise(0)).alias("first_count"),
        F.sum(F.when(idx == F.col("_prev"), F.col("n")).otherwise(0)).alias("prev_count"),
        F.sum(F.when(idx == F.col("_last"), F.col("n")).otherwise(0)).alias("last_count"),
    )
    growth = sc.growth_pct(F.col("prev_count"), F.col("last_count"))
    return counts.withColumn("growth_pct", growth).filter(
        is_spike(F.col("growth_pct"), F.col("last_count"), min_growth, min_count)
    )


def emerging_issues(topics: DataFrame, spiking: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Topics and spikes as one list, ready to be ranked."""
    new = topics.select(
        F.col("topic_label").alias("issue"),
        F.lit("New Topic").alias("type"),
        "total", "first_count", "last_count", "growth_pct",
        F.lit("both").alias("brand"),
    )
    risen = spiking.select(
        F.concat("bucket_label", F.lit(" ("), sc.title_case(F.col("brand")), F.lit(")")).alias("issue"),
        F.lit("Spike").alias("type"),
        F.col("last_count").alias("total"),
        "first_count", "last_count", "growth_pct", "brand",
    )
    if samples is not None:
        lists = sample_lists(samples).withColumnRenamed("topic_label", "issue")
        empty = F.array().cast(SAMPLE)
        new = new.join(lists, "issue", "left").withColumn(
            "samples", F.coalesce("samples", empty)
        )
        risen = risen.withColumn("samples", empty)
    return new.unionByName(risen)


def ranked(issues: DataFrame, k: int | None = None, rank: str | None = None) -> DataFrame:
    """By growth, missing growth as zero, then type and name; ``rank`` names a column for
    the place.  Issues are a few topics and one spike per brand and bucket at most."""
    order = [F.coalesce("growth_pct", F.lit(0.0)).desc(), F.col("type"), F.col("issue")]
    if rank:
        place = F.row_number().over(Window.partitionBy().orderBy(*order))
        issues = issues.withColumn(rank, place)
    out = issues.orderBy(*order)
    return out.limit(k) if k else out
