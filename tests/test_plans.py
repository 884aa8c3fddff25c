"""Physical plans: no Python, no cross joins, limits before shuffles, pushed filters."""

import re

import pytest

from checks import adapters as ad
from checks import load
from voicetide.lexicons import default_taxonomy
from voicetide.operators import classify as cl
from voicetide.operators import cube as cb
from voicetide.operators import dedup as dd
from voicetide.operators import topn as tn

FORBIDDEN = (
    "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
    "CartesianProduct", "BroadcastNestedLoopJoin",
)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(load().QUERIES))
def test_no_python_and_no_cross_join(spark, small, name):
    text = plan(load().QUERIES[name](spark, small))
    assert not [word for word in FORBIDDEN if word in text]


def test_top_n_cuts_before_the_shuffle(spark, small):
    posts = ad.posts_orders(spark, small).select("brand", "bucket", "id", "engagement")
    text = plan(tn.top_n(posts, ["brand", "bucket"], [ad.F.desc("engagement"), ad.F.asc("id")], 8))
    assert text.count("WindowGroupLimit") == 4
    first = text[text.rindex("Exchange hashpartitioning(brand"):]
    assert "Partial" in first and "WindowGroupLimit" in first


def test_top_posts_filter_before_ranking(spark, small):
    orders = ad.posts_orders(spark, small).withColumn("platform", ad.F.lit("p"))
    text = plan(tn.top_posts(orders))
    # No limit and no hint: Spark sizes the floors, and ranking sees filtered rows only.
    assert "GlobalLimit" not in text and "Filter (isnull(_floor" in text
    assert "partial_max" in text
    assert text.index("WindowGroupLimit") < text.index("Filter (isnull(_floor")


def test_top_posts_cut_wide_rows_before_any_shuffle(spark, tmp_path):
    # all posts in one group and equal: joined by a shuffle with the floors, their texts met in one task
    posts = spark.range(20_000).selectExpr(
        "'x' AS brand", "'b' AS bucket", "id", "sha2(string(id), 512) AS text", "0L AS engagement")
    posts.repartition(5).write.parquet(f"{tmp_path}/posts")
    stored = spark.read.parquet(f"{tmp_path}/posts")
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if no side looked small
    try:
        top = tn.top_posts(stored, 8, columns=("id", "text", "engagement"))
        assert sorted((r.id, r.rn) for r in top.collect()) == [(i, i + 1) for i in range(8)]
        text = plan(top)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
    salted = [x for x in re.findall(r"Exchange hashpartitioning\([^\n]*\n[^\n]*", text) if "_salt" in x]
    assert salted and all("WindowGroupLimit" in x and "Partial" in x for x in salted)


@pytest.mark.parametrize("n", [8, 300])
def test_floors_hold_for_many_groups_and_many_rows(spark, n):
    groups = spark.range(12_000).selectExpr("id % 6000 AS brand", "id AS bucket", "id", "id AS engagement")
    one = spark.range(5_000).selectExpr("-1L AS brand", "0L AS bucket", "id + 20000 AS id", "id AS engagement")
    kept = tn.above_floor(groups.union(one), ["brand", "bucket"], "engagement", "id", n)
    big = kept.filter("brand = -1")
    assert kept.count() - big.count() == 12_000
    assert n <= big.count() < 2_000 and big.agg({"engagement": "max"}).first()[0] == 4_999


def test_dedup_has_one_shuffle_and_a_local_limit(spark, small):
    posts = ad.posts_orders(spark, small, platform=False).withColumn("platform", ad.F.lit("p"))
    text = plan(dd.dedup_prefix(posts))
    assert text.count("Exchange") == 1
    assert re.search(r"WindowGroupLimit \[_h.*Partial", text)


def test_calendar_reaches_the_scan_and_columns_are_pruned(spark, small):
    cube = cb.feedback_cube(
        ad.posts_orders(spark, small), ["brand", "month_idx"], ad.CALENDAR, ad.ORDER_BRANDS, True)
    text = plan(cube.select("brand", "month_idx", "n"))
    assert "GreaterThanOrEqual(o_orderdate,1996-04-01" in text
    assert "LessThan(o_orderdate,1996-08-01" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {f.split(":")[0] for f in schema.split(",")} == {"o_orderstatus", "o_orderdate"}


def test_metrics_combine_before_the_shuffle(spark, small):
    text = plan(cb.feedback_cube(ad.posts_orders(spark, small), ["brand", "bucket"]))
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_labelling_is_narrow_and_matches_each_text_once(spark, small):
    tx = default_taxonomy()
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    labelled = cl.label_posts(docs, tx)
    text = plan(labelled)
    assert "Exchange" not in text and "Join" not in text
    assert text.count("regexp_extract_all") == len(tx.buckets) + 2
