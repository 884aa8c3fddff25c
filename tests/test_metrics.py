"""Reports on small literal posts: zero bases, vanished buckets, ties, empty brands."""

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voicetide.config import Bucket, Calendar, Taxonomy
from voicetide.functions import scalars as sc
from voicetide.functions.literals import literal_table
from voicetide.operators import competitive as cp
from voicetide.operators import cube as cb
from voicetide.operators import emerging as em
from voicetide.operators import metrics as mt

TX = Taxonomy((Bucket("A", "A. First"), Bucket("B", "B. Second")), Bucket("I", "I. Other"))
CAL = Calendar.of(2025, (4, 5, 6, 7))
BRANDS = ("x", "y")
SCHEMA = (
    "id string, brand string, bucket string, date timestamp_ntz, platform string, "
    "sentiment string, is_complaint boolean, is_escalation boolean, engagement bigint"
)


def posts(spark, counts):
    """``counts``: (brand, bucket, month or None) -> number of posts."""
    rows = []
    for (brand, bucket, month), n in counts.items():
        date = datetime(2025, month, 3) if month else None
        for _ in range(n):
            rows.append((str(len(rows)), brand, bucket, date, "web", "Neutral", True, False, 1))
    return spark.createDataFrame(rows, SCHEMA)


def cube(spark, counts):
    return cb.feedback_cube(
        posts(spark, counts), ["brand", "bucket", "month_idx"], CAL, BRANDS)


def monthly(spark, counts):
    return mt.monthly_buckets(cube(spark, counts), BRANDS, TX, CAL)


COUNTS = {("x", "A", 4): 2, ("x", "A", 5): 3, ("x", "B", 5): 1, ("x", "I", 4): 4, ("x", "A", None): 5,
          ("x", "A", 12): 7}


def test_monthly_totals_are_dense(spark):
    rows = mt.monthly_totals(cube(spark, COUNTS), BRANDS, CAL).orderBy("brand", "month_idx").collect()
    assert [(r.brand, r.month, r.total) for r in rows] == [
        ("x", "April", 6), ("x", "May", 4), ("x", "June", 0), ("x", "July", 0),
        ("y", "April", 0), ("y", "May", 0), ("y", "June", 0), ("y", "July", 0)]
    assert [r.mom_total_pct for r in rows] == [None, -33.3, -100.0, None, None, None, None, None]


def test_bucket_growth_is_sparse(spark):
    rows = mt.present_only(monthly(spark, COUNTS)).orderBy("month_idx", "bucket").collect()
    got = [(r.month, r.bucket, r.n, r.bucket_pct, r.mom_bucket_pct) for r in rows]
    # I vanishes in May and shows no -100 %; B has no base.
    assert got == [
        ("April", "A", 2, 33.3, None), ("April", "I", 4, 66.7, None),
        ("May", "A", 3, 75.0, 50.0), ("May", "B", 1, 25.0, None)]


def test_movers_use_the_last_month_with_posts(spark):
    changes = mt.first_last_change(monthly(spark, COUNTS))
    assert {(r.bucket, r.change) for r in changes.collect()} == {("A", 1), ("B", 1), ("I", -4)}
    rows = mt.biggest_movers(changes).collect()
    # A and B tie: the label decides.
    assert [tuple(r) for r in rows] == [("x", "A. First", "I. Other")]


def test_shares_count_all_posts_of_the_brand(spark):
    rows = mt.bucket_shares(cube(spark, COUNTS), BRANDS, TX).orderBy("brand", "bucket").collect()
    assert [(r.brand, r.bucket, r["count"], r.share) for r in rows] == [
        ("x", "A", 17, 77.3), ("x", "B", 1, 4.5), ("x", "I", 4, 18.2),
        ("y", "A", 0, 0.0), ("y", "B", 0, 0.0), ("y", "I", 0, 0.0)]


def test_empty_brand_has_zero_kpis(spark):
    rows = mt.overall_kpis(cube(spark, COUNTS), BRANDS).orderBy("brand").collect()
    assert [tuple(r) for r in rows] == [("x", 22, 22, 0, 0), ("y", 0, 0, 0, 0)]
    rates = mt.kpi_rates(
        cb.feedback_cube(posts(spark, COUNTS), ["brand", "platform"]), BRANDS, ["web", "app"])
    assert [tuple(r) for r in rates.orderBy("brand").collect()] == [
        ("x", 22, 100.0, 0.0, 1.0, 22, 0), ("y", 0, 0.0, 0.0, 0.0, 0, 0)]
    shares = mt.sentiment_share(cube(spark, COUNTS), BRANDS).orderBy("brand").collect()
    assert tuple(shares[1]) == ("y", 0, 0.0, 0, 0.0, 0, 0.0)


def test_no_posts_at_all(spark):
    empty = cube(spark, {("x", "A", 4): 0})
    assert cp.competitive_gap(empty, "x", "y", TX).filter("diff_share <> 0").count() == 0
    totals = mt.monthly_totals(empty, BRANDS, CAL)
    row = mt.present_months(totals, CAL, fallback=(1, 2)).first()
    assert (row.present_months, row.prev_idx, row.last_idx) == ([], 1, 2)
    assert em.spikes(mt.monthly_buckets(empty, BRANDS, TX, CAL)).count() == 0


def test_gap_and_lists(spark):
    counts = {("x", "A", 4): 60, ("x", "I", 4): 40, ("y", "A", 4): 50, ("y", "I", 4): 48,
              ("y", "B", 4): 2}
    gaps = cp.competitive_gap(cube(spark, counts), "x", "y", TX)
    rows = {r.bucket: (r.a_share, r.b_share, r.diff_share) for r in gaps.collect()}
    assert rows == {"A": (60.0, 50.0, 10.0), "B": (0.0, 2.0, -2.0), "I": (40.0, 48.0, -8.0)}
    # -2 is not below -2.
    assert tuple(cp.gap_lists(gaps).first()) == (["A. First"], ["I. Other"])
    assert cp.chart_scale(gaps).first()[0] == 65.0
    assert cp.chart_scale(gaps.limit(0)).first()[0] == 30.0


def test_spikes_need_growth_and_volume(spark):
    counts = {("x", "A", 5): 4, ("x", "A", 6): 7, ("x", "B", 5): 1, ("x", "B", 6): 4,
              ("y", "A", 5): 10, ("y", "A", 6): 15, ("y", "I", 6): 9}
    rows = em.spikes(monthly(spark, counts)).collect()
    # B is too small, y/A grew by exactly 50 %, y/I has no base.
    assert [(r.brand, r.bucket, r.prev_count, r.last_count, r.growth_pct) for r in rows] == [
        ("x", "A", 4, 7, 75.0)]


def test_ranking_puts_missing_growth_at_zero(spark):
    rows = spark.createDataFrame(
        [("t1", "New Topic", None), ("t2", "New Topic", -10.0), ("s", "Spike", 60.0),
         ("t0", "New Topic", 0.0)],
        "issue string, type string, growth_pct double")
    assert [r.issue for r in em.ranked(rows).collect()] == ["s", "t0", "t1", "t2"]
    assert [r.issue for r in em.ranked(rows, 2).collect()] == ["s", "t0"]


def test_growth_variants(spark):
    totals = mt.monthly_totals(cube(spark, COUNTS), ("x",), CAL)
    rows = mt.growth_variants(totals).collect()
    got = {r.month: (r.growth_or_null, r.growth_or_na, r.growth_clamped) for r in rows}
    assert got == {"May": (-33.3, "-33.3%", "-33.3%"), "June": (-100.0, "-100.0%", "-100.0%"),
                   "July": (None, "N/A", "+0.0%")}


def test_calendar_with_gaps_and_years(spark):
    from voicetide.config import Period

    cal = Calendar((Period(2024, 12), Period(2025, 3)))
    rows = spark.createDataFrame(
        [(datetime(2024, 12, 31, 23, 59),), (datetime(2025, 1, 1),), (datetime(2025, 3, 31, 12),),
         (datetime(2025, 4, 1),), (datetime(2023, 12, 5),), (None,)], "date timestamp_ntz")
    got = rows.select(cal.index_of(F.col("date")).alias("i"), cal.covers(F.col("date")).alias("c"))
    assert [tuple(r) for r in got.collect()] == [
        (0, True), (None, True), (1, True), (None, False), (None, False), (None, None)]


def test_deep_dive_skips_buckets_without_a_plan(spark):
    gaps = cp.competitive_gap(cube(spark, COUNTS), "x", "y", TX)
    trend = mt.bucket_trend(monthly(spark, COUNTS), CAL)
    plan = literal_table(spark, [("A. First", "why")], "bucket_label string, why string")
    rows = cp.bucket_deep_dive(gaps, trend, plan, "x", CAL).collect()
    assert [(r.bucket_label, r.a_count, r.b_count, r.April, r.May, r.July, r.why) for r in rows] == [
        ("A. First", 17, 0, 2, 3, 0, "why")]


@settings(max_examples=10, deadline=None)
@given(st.lists(
    st.tuples(st.sampled_from("xyz"), st.sampled_from("ABI"), st.sampled_from([4, 5, 6, 7, 9, None])),
    min_size=1, max_size=40,
))
def test_cube_adds_up(spark, keys):
    counts = {}
    for key in keys:
        counts[key] = counts.get(key, 0) + 1
    rows = posts(spark, counts)
    full = cb.feedback_cube(rows, ["brand", "bucket", "month_idx"], CAL).collect()
    assert sum(r.n for r in full) == len(keys)
    shares = mt.bucket_shares(cube(spark, counts), BRANDS, TX).collect()
    for brand in BRANDS:
        mine = sum(n for (b, _, _), n in counts.items() if b == brand)
        assert sum(r["count"] for r in shares if r.brand == brand) == mine
    dense = mt.monthly_buckets(cube(spark, counts), BRANDS, TX, CAL)
    assert dense.count() == len(BRANDS) * 3 * len(CAL)


@pytest.mark.parametrize("part, whole", [(1, 16), (5, 80), (1, 3), (2, 3), (0, 7), (7, 7), (3, 400)])
def test_share_rounds_like_python(spark, part, whole):
    rows = spark.createDataFrame([(part, whole)], "a bigint, b bigint")
    assert rows.select(sc.share_pct(F.col("a"), F.col("b"))).first()[0] == round(part / whole * 100, 1)
