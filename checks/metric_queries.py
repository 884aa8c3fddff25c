"""Aggregations, windows, top-k and brand comparisons over ``posts_orders``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import adapters as ad
from checks.registry import query, with_sql
from voicetide.functions import scalars as sc
from voicetide.functions.literals import literal_table
from voicetide.operators import competitive as cp
from voicetide.operators import cube as cb
from voicetide.operators import emerging as em
from voicetide.operators import filters as fl
from voicetide.operators import metrics as mt
from voicetide.operators import topn as tn

TX, CAL, BRANDS = ad.ORDER_TAXONOMY, ad.CALENDAR, ad.ORDER_BRANDS
A, B = ad.PAIR
PO, DIMS, MONTHLY, SHARES, GAPS = (
    ad.PO_SQL, ad.DIMS_SQL, ad.MONTHLY_SQL, ad.SHARES_SQL, ad.GAPS_SQL,
)


def cube(spark, sf, *keys, platform=False):
    return cb.feedback_cube(ad.posts_orders(spark, sf, platform), keys)


def month_cube(spark, sf, *keys):
    posts = ad.posts_orders(spark, sf)
    return cb.feedback_cube(posts, [*keys, "month_idx"], CAL, BRANDS, calendar_only=True)


def totals(spark, sf):
    return mt.monthly_totals(month_cube(spark, sf, "brand"), BRANDS, CAL)


def monthly(spark, sf):
    return mt.monthly_buckets(month_cube(spark, sf, "brand", "bucket"), BRANDS, TX, CAL)


def shares(spark, sf):
    return mt.bucket_shares(cube(spark, sf, "brand", "bucket"), BRANDS, TX)


def gaps(spark, sf):
    return cp.competitive_gap(cube(spark, sf, "brand", "bucket"), A, B, TX)


# --- aggregations ---------------------------------------------------------

@query("A1_platform_counts", with_sql(
    "SELECT brand, platform, count(*) AS n FROM po GROUP BY ALL", PO))
def _(spark, sf):
    return mt.platform_counts(cube(spark, sf, "brand", "platform", platform=True))


@query("A2_overall_kpis", with_sql("""
SELECT brand, count(*) AS total_posts, count(*) FILTER (WHERE is_complaint) AS complaint_posts,
  count(*) FILTER (WHERE is_escalation) AS escalation_posts,
  count(*) FILTER (WHERE sentiment = 'Negative') AS negative_posts FROM po GROUP BY ALL""", PO))
def _(spark, sf):
    return mt.overall_kpis(cube(spark, sf, "brand"), BRANDS)


@query("A3_monthly_totals", with_sql(
    "SELECT brand, month, total, complaints, escalations, sentiment_neg FROM mt",
    PO, DIMS, MONTHLY))
def _(spark, sf):
    return totals(spark, sf).select(
        "brand", "month", "total", "complaints", "escalations", "sentiment_neg"
    )


@query("A4_monthly_bucket_counts", with_sql(
    "SELECT brand, month, bucket_label, n FROM mb WHERE n > 0", PO, DIMS, MONTHLY))
def _(spark, sf):
    return mt.present_only(monthly(spark, sf)).select("brand", "month", "bucket_label", "n")


@query("A5_monthly_bucket_pct", with_sql("""
SELECT brand, month, bucket_label, bucket_pct FROM (
  SELECT *, round_even(n::DOUBLE / sum(n) OVER (PARTITION BY brand, month_idx) * 100, 1)
    AS bucket_pct FROM mb) WHERE n > 0""", PO, DIMS, MONTHLY))
def _(spark, sf):
    return mt.present_only(monthly(spark, sf)).select(
        "brand", "month", "bucket_label", "bucket_pct"
    )


MOM_SQL = """SELECT brand, month, total, mom_total_pct FROM (
  SELECT *, lag(total) OVER (PARTITION BY brand ORDER BY month_idx) AS p,
    round_even((total - p)::DOUBLE / nullif(p, 0) * 100, 1) AS mom_total_pct FROM mt)"""


@query("A6_mom_total_pct", with_sql(MOM_SQL, PO, DIMS, MONTHLY))
def _(spark, sf):
    return totals(spark, sf).select("brand", "month", "total", "mom_total_pct")


@query("A7_mom_bucket_pct", with_sql("""
SELECT brand, month, bucket_label, n, round_even((n - p)::DOUBLE / nullif(p, 0) * 100, 1)
  AS mom_bucket_pct FROM (
  SELECT *, coalesce(lag(n) OVER (PARTITION BY brand, bucket ORDER BY month_idx), 0) AS p FROM mb)
WHERE n > 0""", PO, DIMS, MONTHLY))
def _(spark, sf):
    return mt.present_only(monthly(spark, sf)).select(
        "brand", "month", "bucket_label", "n", "mom_bucket_pct"
    )


CHANGES_SQL = """lm AS (SELECT brand, coalesce(max(month_idx) FILTER (WHERE total > 0), 2) AS l
  FROM mt GROUP BY brand),
ch AS (SELECT mb.brand, bucket, bucket_label,
    CAST(sum(CASE WHEN month_idx = 0 THEN n ELSE 0 END) AS BIGINT) AS first_n,
    CAST(sum(CASE WHEN month_idx = l THEN n ELSE 0 END) AS BIGINT) AS last_n,
    last_n - first_n AS change
  FROM mb JOIN lm ON mb.brand = lm.brand GROUP BY ALL HAVING first_n > 0 OR last_n > 0)"""


@query("A8_biggest_movers", with_sql("""
SELECT brand, first(bucket_label ORDER BY change DESC, bucket_label) AS biggest_increase,
  first(bucket_label ORDER BY change, bucket_label) AS biggest_decrease FROM ch GROUP BY brand""",
    PO, DIMS, MONTHLY, CHANGES_SQL))
def _(spark, sf):
    return mt.biggest_movers(mt.first_last_change(monthly(spark, sf)))


@query("A9_bucket_count_share", with_sql(
    "SELECT brand, bucket_label, count, share FROM sh", PO, DIMS, SHARES))
def _(spark, sf):
    return shares(spark, sf).select("brand", "bucket_label", "count", "share")


TREND_SQL = """tr AS (SELECT brand, bucket, bucket_label,
  CAST(sum(n) FILTER (WHERE month_idx = 0) AS BIGINT) AS April,
  CAST(sum(n) FILTER (WHERE month_idx = 1) AS BIGINT) AS May,
  CAST(sum(n) FILTER (WHERE month_idx = 2) AS BIGINT) AS June,
  CAST(sum(n) FILTER (WHERE month_idx = 3) AS BIGINT) AS July FROM mb GROUP BY ALL)"""


@query("A10_bucket_trend", with_sql("SELECT * FROM tr", PO, DIMS, MONTHLY, TREND_SQL))
def _(spark, sf):
    return mt.bucket_trend(monthly(spark, sf), CAL)


@query("A11_competitive_gap", with_sql("""SELECT bucket_label, a_count, b_count, a_share, b_share,
  diff_share FROM gp""", PO, DIMS, GAPS))
def competitive_gap(spark, sf):
    return gaps(spark, sf).select(
        "bucket_label", "a_count", "b_count", "a_share", "b_share", "diff_share"
    )


@query("A12_gap_lists", with_sql("""SELECT
  coalesce(string_agg(bucket_label, '|' ORDER BY bucket_ord) FILTER (WHERE diff_share > 0.2), '')
    AS higher_a,
  coalesce(string_agg(bucket_label, '|' ORDER BY bucket_ord) FILTER (WHERE diff_share < -0.2), '')
    AS higher_b FROM gp""", PO, DIMS, GAPS))
def _(spark, sf):
    lists = cp.gap_lists(gaps(spark, sf), points=0.2)
    return lists.select(*[F.array_join(c, "|").alias(c) for c in ("higher_a", "higher_b")])


TOPICS_SQL = """tg AS (SELECT topic_label, count(*) AS total,
    count(*) FILTER (WHERE month_idx = 0) AS first_count,
    count(*) FILTER (WHERE month_idx = 2) AS last_count,
    round_even((last_count - first_count)::DOUBLE / nullif(first_count, 0) * 100, 1) AS growth_pct
  FROM po WHERE bucket = '5-LOW' AND topic_label <> '' GROUP BY topic_label
  ORDER BY total DESC, topic_label LIMIT 5)"""


def topics(spark, sf):
    return em.topic_growth(ad.posts_orders(spark, sf, True), TX.default.key, CAL)


@query("A13_topic_growth", with_sql("SELECT * FROM tg", PO, TOPICS_SQL))
def _(spark, sf):
    return topics(spark, sf)


# Months with posts of any brand, the fixed pair if there are fewer than two.
SPIKES_SQL = """seen AS (SELECT DISTINCT month_idx FROM mb WHERE n > 0),
lp AS (SELECT CASE WHEN count(*) >= 2 THEN max(month_idx) ELSE 2 END AS l,
    CASE WHEN count(*) >= 2 THEN (SELECT max(month_idx) FROM seen
      WHERE month_idx < (SELECT max(month_idx) FROM seen)) ELSE 1 END AS p FROM seen),
sp0 AS (SELECT brand, bucket_label,
    CAST(sum(CASE WHEN month_idx = 0 THEN n ELSE 0 END) AS BIGINT) AS first_count,
    CAST(sum(CASE WHEN month_idx = p THEN n ELSE 0 END) AS BIGINT) AS prev_count,
    CAST(sum(CASE WHEN month_idx = l THEN n ELSE 0 END) AS BIGINT) AS last_count
  FROM mb CROSS JOIN lp GROUP BY ALL),
sp AS (SELECT *, round_even((last_count - prev_count)::DOUBLE / nullif(prev_count, 0) * 100, 1)
    AS growth_pct FROM sp0 WHERE growth_pct > 20 AND last_count >= 5)"""


def spikes(spark, sf):
    return em.spikes(monthly(spark, sf), min_growth=20)


@query("A14_spikes", with_sql("""SELECT brand, bucket_label, first_count, prev_count, last_count,
  growth_pct FROM sp""", PO, DIMS, MONTHLY, SPIKES_SQL))
def _(spark, sf):
    return spikes(spark, sf).select(
        "brand", "bucket_label", "first_count", "prev_count", "last_count", "growth_pct"
    )


EMERGING_SQL = """ei AS (
  SELECT topic_label AS issue, 'New Topic' AS type, total, first_count, last_count, growth_pct,
    'both' AS brand FROM tg
  UNION ALL SELECT bucket_label || ' (' || brand || ')', 'Spike', last_count, first_count,
    last_count, growth_pct, brand FROM sp)"""


def emerging(spark, sf):
    return em.emerging_issues(topics(spark, sf), spikes(spark, sf))


@query("A15_emerging_rank", with_sql("""SELECT *, row_number() OVER
  (ORDER BY coalesce(growth_pct, 0) DESC, type, issue) AS rank FROM ei""",
    PO, DIMS, MONTHLY, TOPICS_SQL, SPIKES_SQL, EMERGING_SQL))
def _(spark, sf):
    return em.ranked(emerging(spark, sf), rank="rank")


@query("A16_sentiment_distribution", with_sql(
    "SELECT brand, sentiment, count(*) AS n FROM po GROUP BY ALL", PO))
def _(spark, sf):
    return mt.sentiment_distribution(cube(spark, sf, "brand"), BRANDS)


@query("A17_sentiment_share", with_sql("""
SELECT brand, count(*) FILTER (WHERE sentiment = 'Negative') AS negatives,
  round_even(negatives::DOUBLE / count(*) * 100, 1) AS negative_pct,
  count(*) FILTER (WHERE sentiment = 'Neutral') AS neutrals,
  round_even(neutrals::DOUBLE / count(*) * 100, 1) AS neutral_pct,
  count(*) FILTER (WHERE sentiment = 'Positive') AS positives,
  round_even(positives::DOUBLE / count(*) * 100, 1) AS positive_pct
FROM po GROUP BY brand""", PO))
def _(spark, sf):
    return mt.sentiment_share(cube(spark, sf, "brand"), BRANDS)


@query("A18_kpi_rates", with_sql("""
SELECT brand, count(*) AS total_posts,
  round_even(count(*) FILTER (WHERE is_complaint)::DOUBLE / count(*) * 100, 1) AS complaint_rate,
  round_even(count(*) FILTER (WHERE is_escalation)::DOUBLE / count(*) * 100, 1) AS escalation_rate,
  round_even(sum(engagement)::DOUBLE / count(*), 1) AS avg_engagement,
""" + ",\n".join(
    f"  count(*) FILTER (WHERE platform = '{p}') AS {p}" for p in ad.PLATFORMS
) + "\nFROM po GROUP BY brand", PO))
def _(spark, sf):
    return mt.kpi_rates(cube(spark, sf, "brand", "platform", platform=True), BRANDS, ad.PLATFORMS)


PRESENT_SQL = """pm AS (SELECT month_idx, any_value(month) AS month, sum(total) AS t FROM mt
  GROUP BY month_idx HAVING t > 0)"""


@query("A19_present_months", with_sql("""SELECT string_agg(month, '|' ORDER BY month_idx)
  AS present_months, CASE WHEN count(*) >= 2 THEN max(month_idx) ELSE 2 END AS last_idx,
  CASE WHEN count(*) >= 2 THEN (SELECT max(month_idx) FROM pm
    WHERE month_idx < (SELECT max(month_idx) FROM pm)) ELSE 1 END AS prev_idx FROM pm""",
    PO, DIMS, MONTHLY, PRESENT_SQL))
def _(spark, sf):
    found = mt.present_months(totals(spark, sf), CAL, fallback=(1, 2))
    return found.withColumn("present_months", F.array_join("present_months", "|"))


TOP_SQL = """tb AS (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY count DESC, bucket_ord)
  AS rn FROM sh)"""


@query("A20_top_buckets", with_sql(
    "SELECT brand, bucket_label, count, share, rn FROM tb WHERE rn <= 3", PO, DIMS, SHARES, TOP_SQL))
def _(spark, sf):
    return mt.top_buckets(shares(spark, sf), 3).select(
        "brand", "bucket_label", "count", "share", "rn"
    )


@query("A21_top_bucket_by_month", with_sql("""SELECT brand, month_idx, month,
  first(bucket_label ORDER BY n DESC, bucket_ord) AS top_bucket, max(n) AS n
  FROM mb WHERE n > 0 GROUP BY brand, month_idx, month""", PO, DIMS, MONTHLY))
def _(spark, sf):
    return mt.top_bucket_by_month(monthly(spark, sf), TX)


DIRECTION_SQL = """td AS (SELECT brand,
  CAST(sum(CASE WHEN month_idx = 0 THEN total ELSE 0 END) AS BIGINT) AS first_total,
  CAST(sum(CASE WHEN month_idx = 2 THEN total ELSE 0 END) AS BIGINT) AS last_total
  FROM mt GROUP BY brand)"""


@query("A22_trend_direction", with_sql("""SELECT brand, first_total, last_total,
  CASE WHEN last_total >= first_total THEN 'increasing' ELSE 'declining' END AS direction FROM td""",
    PO, DIMS, MONTHLY, DIRECTION_SQL))
def _(spark, sf):
    return mt.trend_direction(totals(spark, sf), 0, 2).drop("delta")


@query("A23_delta_abs", with_sql(
    "SELECT brand, last_total - first_total AS delta FROM td", PO, DIMS, MONTHLY, DIRECTION_SQL))
def _(spark, sf):
    return mt.trend_direction(totals(spark, sf), 0, 2).select("brand", "delta")


@query("A24_growth_variants", with_sql("""SELECT brand, month, total,
  round_even((total - p)::DOUBLE / nullif(p, 0) * 100, 1) AS growth_or_null,
  coalesce(CASE WHEN total >= p THEN '+' ELSE '' END || CAST(CAST(growth_or_null AS DECIMAL(20, 1))
    AS VARCHAR) || '%', 'N/A') AS growth_or_na,
  CASE WHEN total >= p THEN '+' ELSE '' END || CAST(CAST(round_even((total - p)::DOUBLE /
    greatest(p, 1) * 100, 1) AS DECIMAL(20, 1)) AS VARCHAR) || '%' AS growth_clamped
FROM (SELECT *, lag(total) OVER (PARTITION BY brand ORDER BY month_idx) AS p FROM mt)
WHERE p IS NOT NULL""", PO, DIMS, MONTHLY))
def _(spark, sf):
    return mt.growth_variants(totals(spark, sf))


@query("A25_brand_differential", with_sql("""SELECT a_complaints, b_complaints,
  CASE WHEN a_complaints >= b_complaints THEN '+' ELSE '' END || CAST(CAST(round_even(
    (a_complaints - b_complaints)::DOUBLE / nullif(b_complaints, 0) * 100, 1) AS DECIMAL(20, 1))
    AS VARCHAR) || '%' AS differential
FROM (SELECT count(*) FILTER (WHERE brand = 'F' AND is_complaint) AS a_complaints,
  count(*) FILTER (WHERE brand = 'O' AND is_complaint) AS b_complaints FROM po)""", PO))
def _(spark, sf):
    return cp.brand_differential(mt.overall_kpis(cube(spark, sf, "brand"), BRANDS), A, B)


@query("A26_negative_share", with_sql("""SELECT brand,
  count(*) FILTER (WHERE sentiment = 'Negative') AS negative_posts,
  round_even(negative_posts::DOUBLE / greatest(count(*), 1) * 100, 1) AS negative_pct
FROM po GROUP BY brand""", PO))
def _(spark, sf):
    return mt.negative_share(cube(spark, sf, "brand"), BRANDS)


@query("A27_group_size_report", with_sql("""SELECT brand, platform, bucket, count(*) AS n FROM po
  GROUP BY GROUPING SETS ((brand, platform), (brand, bucket))""", PO))
def _(spark, sf):
    return cb.group_sizes(ad.posts_orders(spark, sf, True))


@query("A28_source_mix", with_sql("""SELECT count(*) AS total,
  count(*) FILTER (WHERE data_source = 'real') AS real,
  count(*) FILTER (WHERE data_source = 'synthetic') AS synthetic FROM po""", PO))
def _(spark, sf):
    return cb.source_mix(ad.posts_orders(spark, sf))


@query("A29_chart_scale", with_sql(
    "SELECT greatest(max(a_share), max(b_share)) + 5 AS max_val FROM gp", PO, DIMS, GAPS))
def _(spark, sf):
    return cp.chart_scale(gaps(spark, sf))


# --- windows --------------------------------------------------------------

@query("W1_lag_mom", with_sql("""SELECT brand, bucket_label, month, n,
  lag(n) OVER (PARTITION BY brand, bucket ORDER BY month_idx) AS prev_n FROM mb""",
    PO, DIMS, MONTHLY))
def _(spark, sf):
    return monthly(spark, sf).select("brand", "bucket_label", "month", "n", "prev_n")


RANKED_SQL = """rk AS (SELECT *, strftime(date, '%Y-%m-%d %H:%M:%S') AS day, row_number() OVER
  (PARTITION BY brand, bucket ORDER BY engagement DESC, id) AS rn FROM po)"""


@query("W2_topn_per_group", with_sql(
    "SELECT brand, platform, id, engagement, rn FROM (SELECT *, row_number() OVER (PARTITION BY "
    "brand, platform ORDER BY engagement DESC, id) AS rn FROM po) WHERE rn <= 5", PO))
def _(spark, sf):
    posts = ad.posts_orders(spark, sf, True).select("brand", "platform", "id", "engagement")
    return tn.top_n(posts, ["brand", "platform"], [F.desc("engagement"), F.asc("id")], 5)


@query("W3_share_of_total", with_sql("""SELECT brand, month, bucket_label, n,
  CAST(sum(n) OVER (PARTITION BY brand, month_idx) AS BIGINT) AS month_total FROM mb""",
    PO, DIMS, MONTHLY))
def _(spark, sf):
    return monthly(spark, sf).select("brand", "month", "bucket_label", "n", "month_total")


@query("W4_first_last_period", with_sql("""SELECT brand, first(month ORDER BY month_idx) AS first_month,
  last(month ORDER BY month_idx) AS last_month, first(total ORDER BY month_idx) AS first_total,
  last(total ORDER BY month_idx) AS last_total FROM mt WHERE total > 0 GROUP BY brand""",
    PO, DIMS, MONTHLY))
def _(spark, sf):
    return mt.first_last_period(totals(spark, sf), CAL)


# --- top-k ----------------------------------------------------------------

@query("T1_representative_posts", with_sql("""SELECT brand, bucket, id, text, platform, day AS date,
  engagement, sentiment, url, rn FROM rk WHERE rn <= 8""", PO, RANKED_SQL))
def representative_posts(spark, sf):
    top = tn.top_posts(ad.posts_orders(spark, sf, True))
    return top.withColumn("date", sc.second_label(F.col("date")))


@query("T2_top_topics", with_sql("SELECT topic_label, total FROM tg", PO, TOPICS_SQL))
def _(spark, sf):
    return topics(spark, sf).select("topic_label", "total")


@query("T3_topic_samples", with_sql("""SELECT topic_label, string_agg(text || '|' || platform || '|'
    || strftime(date, '%Y-%m-%d %H:%M:%S') || '|' || CAST(engagement AS VARCHAR), ';' ORDER BY rn)
    AS samples FROM (
  SELECT po.*, row_number() OVER (PARTITION BY topic_label ORDER BY engagement DESC, id) AS rn
  FROM po JOIN tg USING (topic_label) WHERE bucket = '5-LOW') WHERE rn <= 3 GROUP BY topic_label""",
    PO, TOPICS_SQL))
def _(spark, sf):
    posts = ad.posts_orders(spark, sf, True)
    lists = em.sample_lists(em.topic_samples(posts, topics(spark, sf), TX.default.key))
    one = F.transform("samples", lambda s: F.concat_ws(
        "|", s["text"], s["platform"], s["date"], s["engagement"].cast("string")))
    return lists.select("topic_label", F.array_join(one, ";").alias("samples"))


@query("T4_preview", with_sql("""SELECT brand, id, strftime(date, '%Y-%m-%d') AS date, engagement
  FROM po ORDER BY po.date, id LIMIT 500""", PO))
def _(spark, sf):
    first = tn.preview(ad.posts_orders(spark, sf), 500)
    return first.select("brand", "id", sc.day_label(F.col("date")).alias("date"), "engagement")


@query("T5_top_emerging", with_sql("""SELECT issue, type, total, growth_pct FROM ei
  ORDER BY coalesce(growth_pct, 0) DESC, type, issue LIMIT 6""",
    PO, DIMS, MONTHLY, TOPICS_SQL, SPIKES_SQL, EMERGING_SQL))
def _(spark, sf):
    return em.ranked(emerging(spark, sf), 6).select("issue", "type", "total", "growth_pct")


@query("T6_sorted_gap", with_sql("""SELECT bucket_label, diff_share, row_number() OVER
  (ORDER BY diff_share DESC, bucket) AS pos FROM gp""", PO, DIMS, GAPS))
def _(spark, sf):
    ordered = cp.sorted_gap(gaps(spark, sf))
    window = Window.partitionBy().orderBy(F.desc("diff_share"), "bucket")
    return ordered.select("bucket_label", "diff_share", F.row_number().over(window).alias("pos"))


@query("T7_first_k_of_k", with_sql("""SELECT brand, bucket, id, engagement, rn FROM rk
  WHERE rn <= 2 AND bucket IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')""",
    PO, RANKED_SQL))
def _(spark, sf):
    posts = ad.posts_orders(spark, sf)
    first = posts.filter(TX.order_of(F.col("bucket")) < 4)
    return tn.top_posts(first, 2, columns=("id", "engagement"))


# --- joins on the cube ----------------------------------------------------

@query("J2_dense_fill", with_sql(
    "SELECT brand, bucket, month_idx, n FROM mb", PO, DIMS, MONTHLY))
def _(spark, sf):
    axes = {"brand": BRANDS, "bucket": TX.keys, "month_idx": range(len(CAL))}
    dense = cb.dense_fill(month_cube(spark, sf, "brand", "bucket"), axes)
    return dense.select("brand", "bucket", "month_idx", "n")


@query("J3_prior_period_lookup", with_sql("""SELECT c.brand, c.month, c.total, p.total AS prev_total
  FROM mt c LEFT JOIN mt p ON c.brand = p.brand AND p.month_idx = c.month_idx - 1""",
    PO, DIMS, MONTHLY))
def _(spark, sf):
    return totals(spark, sf).select("brand", "month", "total", "prev_total")


@query("J4_key_union_diff", with_sql("""SELECT coalesce(f.brand, l.brand) AS brand,
    coalesce(f.bucket_label, l.bucket_label) AS bucket_label, coalesce(f.n, 0) AS first_n,
    coalesce(l.n, 0) AS last_n, coalesce(l.n, 0) - coalesce(f.n, 0) AS change
  FROM (SELECT * FROM mb WHERE month_idx = 0 AND n > 0) f
  FULL OUTER JOIN (SELECT * FROM mb WHERE month_idx = 3 AND n > 0) l
  ON f.brand = l.brand AND f.bucket = l.bucket""", PO, DIMS, MONTHLY))
def _(spark, sf):
    return mt.first_last_change(monthly(spark, sf)).drop("bucket")


PLAN = [
    ("A. Urgent", "urgent posts spread", ["late hand-over"], ["call back"]),
    ("C. Medium", "volume", ["unclear text", "no owner"], ["rewrite", "assign"]),
    ("Z. Unknown", "never matched", [], []),
]


@query("J5_dim_inner", with_sql("""SELECT gp.bucket_label, a_count, a_share, b_count, b_share, April,
    May, June, July, why, root_causes, recommendations FROM gp
  JOIN (VALUES ('A. Urgent', 'urgent posts spread', 'late hand-over', 'call back'),
    ('C. Medium', 'volume', 'unclear text|no owner', 'rewrite|assign'),
    ('Z. Unknown', 'never matched', '', '')) p(bucket_label, why, root_causes, recommendations)
    ON p.bucket_label = gp.bucket_label
  LEFT JOIN (SELECT * FROM tr WHERE brand = 'F') t ON t.bucket_label = gp.bucket_label""",
    PO, DIMS, MONTHLY, TREND_SQL, GAPS))
def _(spark, sf):
    plan = literal_table(
        spark, [(a, b, "|".join(c), "|".join(d)) for a, b, c, d in PLAN],
        "bucket_label string, why string, root_causes string, recommendations string",
    )
    trend = mt.bucket_trend(monthly(spark, sf), CAL)
    dive = cp.bucket_deep_dive(gaps(spark, sf), trend, plan, A, CAL)
    return dive.drop("bucket", "bucket_ord", "diff_share")


@query("J5_dim_lists", with_sql("""SELECT gp.bucket_label, a_share, kind, pos, item FROM gp
  JOIN (VALUES ('A. Urgent', 'root_causes', 0, 'late hand-over'), ('A. Urgent', 'recommendations', 0, 'call back'),
    ('C. Medium', 'root_causes', 0, 'unclear text'), ('C. Medium', 'root_causes', 1, 'no owner'),
    ('C. Medium', 'recommendations', 0, 'rewrite'), ('C. Medium', 'recommendations', 1, 'assign'))
    p(bucket_label, kind, pos, item) USING (bucket_label)""", PO, DIMS, GAPS))
def _(spark, sf):
    """The plan's lists joined as arrays, their elements compared in order."""
    plan = spark.createDataFrame(
        PLAN, "bucket_label string, why string, root_causes array<string>, recommendations array<string>")
    dive = cp.bucket_deep_dive(gaps(spark, sf), mt.bucket_trend(monthly(spark, sf), CAL), plan, A, CAL)
    lists = [
        dive.select("bucket_label", "a_share", F.lit(kind).alias("kind"), F.posexplode(kind).alias("pos", "item"))
        for kind in ("root_causes", "recommendations")
    ]
    return lists[0].unionByName(lists[1])


@query("J6_brand_vs_brand", with_sql("SELECT bucket, a_count, b_count FROM pc", PO, DIMS, GAPS))
def _(spark, sf):
    return cp.brand_pair(cube(spark, sf, "brand", "bucket"), A, B, TX)


# --- filters over the metric view -------------------------------------------

@query("F4_slice_equals", with_sql("""SELECT id, engagement FROM po WHERE brand = 'F'
  AND month_idx = 1 AND bucket = '2-HIGH'""", PO))
def _(spark, sf):
    posts = ad.posts_orders(spark, sf)
    sliced = fl.slice_equals(posts.filter(CAL.covers(F.col("date"))), brand="F", bucket="2-HIGH")
    return sliced.filter(CAL.index_of(F.col("date")) == 1).select("id", "engagement")


@query("F5_multiselect", with_sql("""SELECT id, brand, platform FROM po
  WHERE brand IN ('F', 'O') AND platform IN ('BUILDING', 'MACHINERY')""", PO))
def _(spark, sf):
    posts = ad.posts_orders(spark, sf, True)
    chosen = fl.multiselect(posts, brand=["F", "O"], bucket=[], platform=["BUILDING", "MACHINERY"])
    return chosen.select("id", "brand", "platform")


@query("F7_non_empty_topic", with_sql(
    "SELECT id, topic_label FROM po WHERE topic_label <> ''", PO))
def _(spark, sf):
    return fl.non_empty_topic(ad.posts_orders(spark, sf, True)).select("id", "topic_label")


@query("F8_spike_predicate", with_sql("""SELECT brand, bucket_label, month, n, prev_n,
  round_even((n - prev_n)::DOUBLE / nullif(prev_n, 0) * 100, 1) AS growth,
  coalesce(growth > 50 AND n >= 5, false) AS spike FROM (
  SELECT *, lag(n) OVER (PARTITION BY brand, bucket ORDER BY month_idx) AS prev_n FROM mb)""",
    PO, DIMS, MONTHLY))
def _(spark, sf):
    rows = monthly(spark, sf).select(
        "brand", "bucket_label", "month", "n", "prev_n",
        sc.growth_pct(F.col("prev_n"), F.col("n")).alias("growth"),
    )
    return rows.withColumn("spike", fl.is_spike(F.col("growth"), F.col("n")))


@query("F9_gap_significance", with_sql("""SELECT bucket_label, diff_share, CASE WHEN diff_share > 0.2
  THEN 'higher' WHEN diff_share < -0.2 THEN 'lower' ELSE 'similar' END AS side FROM gp""",
    PO, DIMS, GAPS))
def _(spark, sf):
    return gaps(spark, sf).select(
        "bucket_label", "diff_share",
        fl.gap_significance(F.col("diff_share"), 0.2).alias("side"),
    )


# --- display projections ----------------------------------------------------

@query("P10_bucket_label_map", with_sql("""SELECT id, po.bucket, bucket_label
  FROM po LEFT JOIN bk ON bk.bucket = po.bucket""", PO, DIMS))
def _(spark, sf):
    posts = ad.posts_orders(spark, sf).select("id", "bucket")
    return posts.withColumn("bucket_label", TX.label_of(F.col("bucket")))


@query("P12_date_to_string", with_sql(
    "SELECT id, strftime(date, '%Y-%m-%d %H:%M:%S') AS date FROM po", PO))
def _(spark, sf):
    return ad.posts_orders(spark, sf).select("id", sc.second_label(F.col("date")).alias("date"))


@query("P16_number_format", with_sql(
    "SELECT brand, format('{:,}', count(*)) AS posts FROM po GROUP BY brand", PO))
def _(spark, sf):
    kpis = mt.overall_kpis(cube(spark, sf, "brand"), BRANDS)
    return kpis.select("brand", sc.number_label(F.col("total_posts")).alias("posts"))


@query("P17_growth_label", with_sql("""SELECT brand, month, CASE WHEN coalesce(mom_total_pct, 0) = 0
  THEN 'New' WHEN mom_total_pct > 0 THEN '+' || CAST(mom_total_pct AS VARCHAR) || '% MoM'
  ELSE CAST(mom_total_pct AS VARCHAR) || '% MoM' END AS label FROM (""" + MOM_SQL + ")",
    PO, DIMS, MONTHLY))
def _(spark, sf):
    return totals(spark, sf).select(
        "brand", "month", sc.growth_label(F.col("mom_total_pct")).alias("label")
    )


@query("P18_label_parts", with_sql("""SELECT DISTINCT id, regexp_replace(bucket_label, '^[^.]*\\. ', '')
  AS plain, 'Order ' || id AS title FROM po JOIN bk USING (bucket)""",
    PO, DIMS))
def _(spark, sf):
    posts = ad.posts_orders(spark, sf)
    label = TX.label_of(F.col("bucket"))
    title = sc.title_case(F.concat(F.lit("order "), F.col("id")))
    return posts.select("id", sc.plain_label(label).alias("plain"), title.alias("title"))
