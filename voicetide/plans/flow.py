"""From landed JSON to the reports, as three lazy plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voicetide.config import Calendar, FocusRule, Taxonomy
from voicetide.operators import competitive as cp
from voicetide.operators import emerging as em
from voicetide.operators import metrics as mt
from voicetide.operators.classify import label_posts
from voicetide.operators.cube import feedback_cube
from voicetide.operators.dedup import dedup_prefix
from voicetide.operators.filters import date_window, focus_filter
from voicetide.operators.normalise import (
    NORMALISERS,
    add_month_columns,
    tag_source,
)
from voicetide.operators.topics import detect_topics
from voicetide.operators.topn import top_posts
from voicetide.operators.unions import union_all
from voicetide.session import materialise
from voicetide.sources import document as doc
from voicetide.sources.raw_json import read_raw


def unify(
    normalised: Sequence[DataFrame],
    rules: Mapping[str, FocusRule],
    window: tuple[str, str],
    data_source: str = "real",
) -> DataFrame:
    """Union, focus filter, date window, dedup, month columns.

    Filters are row predicates, so Spark runs them below the union and before
    the one shuffle (dedup).
    """
    posts = date_window(focus_filter(union_all(normalised), rules), *window, computed=True)
    return tag_source(add_month_columns(dedup_prefix(posts)), data_source)


def unified_posts(
    spark: SparkSession,
    root: str,
    rules: Mapping[str, FocusRule],
    window: tuple[str, str],
    json_arrays: bool = True,
) -> DataFrame:
    """All landed sources of all brands as one post table."""
    brands = list(rules)
    frames = [
        normalise(read_raw(spark, root, brands, source, json_arrays))
        for source, normalise in NORMALISERS.items()
    ]
    return unify(frames, rules, window)


def classified_posts(posts: DataFrame, taxonomy: Taxonomy, n_topics: int = 10) -> DataFrame:
    """Bucket, confidence, sentiment, flags and topic of every post.

    Topics need several passes over the default bucket, so the labelled posts
    are written to the shared folder once, by bucket, and read back from there:
    those passes then read no other bucket.
    """
    labelled = materialise(label_posts(posts, taxonomy), "labelled", ["bucket"])
    return detect_topics(labelled, taxonomy.default.key, n_topics=n_topics)


def reports(
    posts: DataFrame,
    brands: tuple[str, str],
    taxonomy: Taxonomy,
    calendar: Calendar,
    gap_points: float = 2,
    n_posts: int = 8,
) -> dict[str, DataFrame]:
    """Every report.  Posts are aggregated once; the cube and the two tables most
    reports start from are written, all of them a few hundred rows."""
    a, b = brands
    last = len(calendar) - 1
    cube = materialise(
        feedback_cube(
            posts, ["brand", "platform", "bucket", "month_idx"], calendar, brands=brands
        ),
        "cube",
    )
    ranked = top_posts(posts.filter(F.col("brand").isin(a, b)), n_posts)
    top = materialise(ranked, "top-posts")
    monthly = materialise(mt.monthly_buckets(cube, brands, taxonomy, calendar), "monthly")
    gaps = materialise(cp.competitive_gap(cube, a, b, taxonomy), "gaps")
    first_last = (0, min(2, last))
    growth = em.topic_growth(posts, taxonomy.default.key, calendar, *first_last)
    topics = materialise(growth, "topics")  # a few rows, used by the issues and their samples
    samples = em.topic_samples(posts, topics, taxonomy.default.key)
    return {
        "platform_counts": mt.platform_counts(cube),
        "kpis": mt.overall_kpis(cube, brands),
        "monthly_totals": mt.monthly_totals(cube, brands, calendar),
        "monthly_buckets": monthly,
        "biggest_movers": mt.biggest_movers(mt.first_last_change(monthly, 0, first_last[1])),
        "bucket_shares": mt.bucket_shares(cube, brands, taxonomy),
        "competitive": gaps,
        "gap_lists": cp.gap_lists(gaps, gap_points),
        "emerging": em.emerging_issues(
            topics, em.spikes(monthly, fallback=(min(1, last), min(2, last))), samples
        ),
        "top_posts": top,
    }


def write_reports(
    marts: Mapping[str, DataFrame],
    path: str,
    brands: tuple[str, str],
    taxonomy: Taxonomy,
    gap_points: float = 2,
) -> None:
    """The nested analytics document under ``path``."""
    doc.write_document(doc.sections(marts, brands, taxonomy, gap_points), path)
