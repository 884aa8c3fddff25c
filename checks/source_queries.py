"""Sources, sinks and normalisation over items that Spark derives from the documents.

``posts_docs`` is turned into landed items of each platform.  The language
decides which fields an item has, so every fallback is used on real rows.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import adapters as ad
from checks import metric_queries as mq
from checks.registry import query, with_sql
from checks.text_queries import RULES, FOCUS_SQL, TX, WINDOW_SQL, classify_sql, flag_sql, sentiment_sql
from voicetide import lexicons as lx
from voicetide import schema as S
from voicetide.functions import scalars as sc
from voicetide.functions import timestamps as ts
from voicetide.operators import normalise as nm
from voicetide.operators.classify import classify_posts, label_posts
from voicetide.plans import flow
from voicetide.session import fresh_path
from voicetide.sources import commits as cm
from voicetide.sources import document as doc
from voicetide.sources import raw_json as rj
from voicetide.sources import tables as tb
from voicetide.streaming import landed as ld

PD, PO = ad.PD_SQL, ad.PO_SQL
ISO = "yyyy-MM-dd'T'HH:mm:ss"


def _columns():
    epoch = F.timestamp_diff(
        "SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("date")
    )
    return F.col("id"), F.col("text"), F.col("likes"), F.col("engagement"), epoch


def _by_lang(**values):
    """The value given for the row's language, null for the others."""
    out = F.lit(None)
    for lang, value in values.items():
        out = F.when(F.col("brand") == lang, value).otherwise(out)
    return out


def _variant(**values):
    out = F.lit(None).cast("variant")
    for lang, value in values.items():
        out = F.when(F.col("brand") == lang, value.cast("variant")).otherwise(out)
    return out


def _object(name, value):
    return F.to_variant_object(F.struct(value.alias(name)))


def _iso(suffix=""):
    return F.date_format("date", ISO + suffix)


def microblog_items(posts):
    id_, text, likes, score, epoch = _columns()
    handle = F.concat(F.lit("v"), id_)
    return posts.select(
        "brand",
        _variant(en=id_.cast("bigint"), de=F.lit(0), es=F.concat(F.lit("x"), id_)).alias("id"),
        _variant(fr=F.concat(F.lit("s"), id_), de=F.concat(F.lit("s"), id_)).alias("id_str"),
        _by_lang(en=text, de=F.lit(""), es=text).alias("text"),
        _by_lang(fr=text).alias("full_text"),
        _by_lang(de=text).alias("rawContent"),
        _variant(en=_iso(".SSS'Z'"), de=epoch, es=F.lit("")).alias("createdAt"),
        _variant(
            fr=F.date_format("date", "EEE MMM dd HH:mm:ss '+0000' yyyy"),
            es=F.date_format("date", "yyyy-MM-dd"),
        ).alias("created_at"),
        _by_lang(en=F.col("url"), es=F.lit("")).alias("url"),
        _by_lang(fr=F.col("url"), es=F.col("url")).alias("tweetUrl"),
        _by_lang(en=likes, de=F.lit(0).cast("bigint")).alias("likeCount"),
        _by_lang(fr=likes, de=likes).alias("favorite_count"),
        _by_lang(en=score).alias("retweetCount"),
        _by_lang(fr=score).alias("retweet_count"),
        _by_lang(de=likes).alias("replyCount"),
        _by_lang(en=_object("userName", F.concat(F.lit("u"), id_))).alias("author"),
        _by_lang(fr=_object("screen_name", handle), de=_object("screen_name", handle)).alias("user"),
    )


def forum_items(posts):
    id_, text, likes, score, epoch = _columns()
    return posts.select(
        "brand",
        id_.cast("variant").alias("id"),
        _by_lang(en=F.col("platform"), fr=F.col("platform")).alias("title"),
        _by_lang(en=text).alias("body"),
        _by_lang(de=F.concat(F.lit("\n "), text)).alias("selftext"),
        _by_lang(es=text).alias("text"),
        _variant(en=_iso("'+05:30'"), de=epoch.cast("string"), es=F.lit("yesterday")).alias("createdAt"),
        _variant(fr=epoch).alias("created_utc"),
        _by_lang(en=F.col("url")).alias("url"),
        _by_lang(fr=F.col("url")).alias("permalink"),
        _by_lang(en=likes, de=likes).alias("score"),
        _by_lang(fr=likes).alias("ups"),
        _by_lang(en=score).alias("numComments"),
        _by_lang(fr=score).alias("num_comments"),
        _variant(en=F.concat(F.lit("u"), id_)).alias("author"),
    )


def professional_items(posts):
    id_, text, likes, score, epoch = _columns()
    return posts.select(
        "brand",
        _variant(en=id_, de=F.lit("")).alias("id"),
        _variant(fr=F.concat(F.lit("urn:"), id_), de=F.concat(F.lit("urn:"), id_)).alias("urn"),
        _by_lang(en=text).alias("text"),
        _by_lang(fr=text).alias("commentary"),
        _by_lang(de=text).alias("content"),
        _by_lang(es=text).alias("body"),
        _variant(en=_iso("'Z'")).alias("postedAt"),
        _variant(fr=_iso()).alias("publishedAt"),
        _variant(de=epoch.cast("double")).alias("date"),
        _by_lang(en=F.col("url")).alias("url"),
        _by_lang(fr=F.col("url")).alias("postUrl"),
        _by_lang(en=score).alias("totalReactionCount"),
        _by_lang(fr=likes).alias("likes"),
        _by_lang(en=likes).alias("repostCount"),
        _by_lang(en=likes).alias("commentsCount"),
        _by_lang(fr=score).alias("comments"),
        _by_lang(en=_object("name", F.concat(F.lit("u"), id_))).alias("author"),
        _by_lang(de=F.concat(F.lit("u"), id_)).alias("authorName"),
    )


ITEMS = {"twitter": microblog_items, "reddit": forum_items, "linkedin": professional_items}


def land(spark, sf, sources=tuple(ITEMS), langs=ad.LANGS, posts=None):
    """Write the items of all documents as JSON Lines, one folder per brand and source."""
    root = fresh_path(spark, "landed")
    posts = posts or flow.materialise(ad.posts_docs(spark, sf), "to-land")
    for source in sources:
        items = ITEMS[source](posts)
        for lang in langs:
            rj.write_raw(
                items.filter(F.col("brand") == lang).drop("brand"), rj.raw_path(root, lang, source)
            )
    return root


def read_landed(spark, sf, source):
    """Landed items of one source; one brand has no data at all."""
    root = land(spark, sf, [source])
    return rj.read_raw(spark, root, [*ad.LANGS, "xx"], source, json_arrays=False)


def shown(posts):
    """Dates as text, so that both engines print them alike."""
    return posts.withColumn("date", sc.second_label(F.col("date")))


def by_lang_sql(default="NULL", **values):
    cases = " ".join(f"WHEN '{lang}' THEN {value}" for lang, value in values.items())
    return f"CASE brand {cases} ELSE {default} END"


DAY = "strftime(date, '%Y-%m-%d %H:%M:%S')"
MIDNIGHT = "strftime(date_trunc('day', date), '%Y-%m-%d %H:%M:%S')"

MICROBLOG_SQL = f"""mi AS (SELECT brand, 'Twitter/X' AS platform,
  {by_lang_sql(en="CASE WHEN id = '0' THEN '' ELSE id END", fr="'s' || id", de="'s' || id",
    es="'x' || id")} AS id, text,
  {by_lang_sql(en=DAY, fr=DAY, de=DAY, es=MIDNIGHT)} AS date,
  {by_lang_sql("url", de="''")} AS url,
  {by_lang_sql("likes", es="0")} AS likes, {by_lang_sql("0", en="engagement", fr="engagement")} AS retweets,
  {by_lang_sql("0", de="likes")} AS replies,
  {by_lang_sql("0", en="likes + engagement", de="likes")} AS engagement,
  {by_lang_sql("''", en="'u' || id", fr="'v' || id", de="'v' || id")} AS author FROM pd)"""

TRIM = f"'{sc.WHITESPACE}'"
FORUM_SQL = f"""fo AS (SELECT brand, 'Reddit' AS platform, id,
  trim({by_lang_sql("' ' || text", en="platform || ' ' || text", fr="platform || ' ' || platform")}, {TRIM})
    AS text,
  {by_lang_sql(en="strftime(date - INTERVAL '5 hours 30 minutes', '%Y-%m-%d %H:%M:%S')", fr=DAY)} AS date,
  {by_lang_sql("''", en="url", fr="url")} AS url,
  {by_lang_sql("likes", es="0")} AS likes, 0 AS retweets,
  {by_lang_sql("0", en="engagement", fr="engagement")} AS replies,
  {by_lang_sql("0", en="likes + engagement", de="likes")} AS engagement,
  {by_lang_sql("''", en="'u' || id")} AS author FROM pd)"""

PROFESSIONAL_SQL = f"""pr AS (SELECT brand, 'LinkedIn' AS platform,
  {by_lang_sql("''", en="id", fr="'urn:' || id", de="'urn:' || id")} AS id, text,
  {by_lang_sql(en=DAY, fr=DAY, de=DAY)} AS date, {by_lang_sql("''", en="url", fr="url")} AS url,
  {by_lang_sql("0", en="engagement", fr="likes")} AS likes, {by_lang_sql("0", en="likes")} AS retweets,
  {by_lang_sql("0", en="likes", fr="engagement")} AS replies,
  {by_lang_sql("0", en="likes + engagement")} AS engagement,
  {by_lang_sql("''", en="'u' || id", de="'u' || id")} AS author FROM pd)"""


# --- normalisation ------------------------------------------------------------

@query("P1_normalise_microblog", with_sql("SELECT * FROM mi", PD, MICROBLOG_SQL))
def _(spark, sf):
    return shown(nm.normalise_microblog(microblog_items(ad.posts_docs(spark, sf))))


@query("P2_normalise_forum", with_sql("SELECT * FROM fo", PD, FORUM_SQL))
def _(spark, sf):
    return shown(nm.normalise_forum(forum_items(ad.posts_docs(spark, sf))))


@query("P3_normalise_professional", with_sql("SELECT * FROM pr", PD, PROFESSIONAL_SQL))
def _(spark, sf):
    return shown(nm.normalise_professional(professional_items(ad.posts_docs(spark, sf))))


@query("P4_truthy_coalesce", """SELECT o_orderkey AS id,
  CASE WHEN o_orderstatus = 'F' THEN lower(o_orderpriority) ELSE 'none' END AS label,
  CASE WHEN floor(o_totalprice / 100000) > 0 THEN CAST(floor(o_totalprice / 100000) AS BIGINT)
    ELSE o_custkey END AS score FROM orders""")
def _(spark, sf):
    orders = ad.table(spark, sf, "orders")
    first = F.when(F.col("o_orderstatus") == "O", F.lit(""))
    second = F.when(F.col("o_orderstatus") == "F", F.lower("o_orderpriority"))
    return orders.select(
        F.col("o_orderkey").alias("id"),
        sc.first_truthy([first, second], "none").alias("label"),
        sc.first_nonzero(
            [F.floor(F.col("o_totalprice") / 100000).cast("bigint"), F.col("o_custkey")]
        ).alias("score"),
    )


@query("P5_nested_author", with_sql("SELECT brand, id, author FROM mi", PD, MICROBLOG_SQL))
def _(spark, sf):
    posts = nm.normalise_microblog(read_landed(spark, sf, "twitter"))
    return posts.select("brand", "id", "author")


@query("P6_engagement_sum", """SELECT event_id, CASE WHEN event_type = 'click' THEN user_id ELSE 0 END
  + CAST(json_extract(props, '$.k') AS BIGINT) AS engagement FROM events""")
def _(spark, sf):
    events = ad.table(spark, sf, "events")
    parts = [
        F.when(F.col("event_type") == "click", F.col("user_id")),
        F.get_json_object("props", "$.k").cast("bigint"),
        F.lit(None).cast("bigint"),
    ]
    return events.select("event_id", sc.null_to_zero_sum(parts).alias("engagement"))


@query("P7_tag_constants", """SELECT doc_id, 'real' AS data_source, 'Reddit' AS platform FROM documents""")
def _(spark, sf):
    docs = ad.table(spark, sf, "documents").select("doc_id")
    return nm.tag_source(docs, "real").withColumn("platform", F.lit(S.FORUM))


P8_SQL = {
    "en": DAY,
    "fr": DAY,
    "de": "strftime(date - INTERVAL 2 HOURS, '%Y-%m-%d %H:%M:%S')",
    "es": MIDNIGHT,
}


@query("P8_parse_timestamp", with_sql(
    f"SELECT id, {DAY} AS epoch, {by_lang_sql(**P8_SQL)} AS date, "
    "NULL::VARCHAR AS digits, NULL::VARCHAR AS garbage FROM pd", PD))
def _(spark, sf):
    posts = ad.posts_docs(spark, sf)
    epoch = _columns()[-1]
    text = _by_lang(
        en=_iso(".SSS'Z'"),
        fr=F.date_format("date", "EEE MMM dd HH:mm:ss '+0000' yyyy"),
        de=_iso("'+02:00'"),
        es=F.date_format("date", "MMM d, yyyy"),
    )
    label = sc.second_label
    return posts.select(
        "id",
        label(ts.variant_to_utc(epoch.cast("variant"))).alias("epoch"),
        label(ts.variant_to_utc(text.cast("variant"))).alias("date"),
        label(ts.variant_to_utc(epoch.cast("string").cast("variant"))).alias("digits"),
        label(ts.text_to_utc(F.concat(F.lit("on "), text))).alias("garbage"),
    )


@query("P9_month_columns", with_sql(
    """SELECT id, CASE WHEN brand = 'es' THEN 'Unknown' ELSE strftime(date, '%B') END AS month,
  CASE WHEN brand = 'es' THEN 0 ELSE month(date) END AS month_num FROM pd""", PD))
def _(spark, sf):
    posts = ad.posts_docs(spark, sf)
    some_null = posts.withColumn("date", F.when(F.col("brand") != "es", F.col("date")))
    return nm.add_month_columns(some_null).select("id", "month", "month_num")


@query("P13_coerce_date", with_sql(
    f"SELECT id, CASE WHEN brand IN ('en', 'de') THEN {DAY} END AS date FROM pd", PD))
def _(spark, sf):
    posts = ad.posts_docs(spark, sf)
    raw = _by_lang(en=F.date_format("date", "yyyy-MM-dd HH:mm:ss"), de=_iso(), fr=F.lit("NaT"))
    return posts.select("id", sc.second_label(ts.coerce_timestamp(raw)).alias("date"))


# --- sources and sinks ----------------------------------------------------------

@query("S1_raw_json_scan", with_sql(
    "SELECT brand, CASE WHEN brand IN ('en', 'es') THEN text WHEN brand = 'de' THEN '' END AS text, "
    "CASE WHEN brand = 'en' THEN engagement END AS retweets FROM pd", PD))
def _(spark, sf):
    items = read_landed(spark, sf, "twitter")
    retweets = F.try_variant_get(F.col("retweetCount"), "$", "bigint")
    return items.select("brand", "text", retweets.alias("retweets"))


@query("S1_json_arrays", with_sql(
    "SELECT brand, CASE WHEN brand IN ('en', 'es') THEN text WHEN brand = 'de' THEN '' END AS text, "
    "CASE WHEN brand = 'en' THEN engagement END AS retweets FROM pd", PD))
def _(spark, sf):
    """Items landed as JSON arrays of up to 256 records, one array a file."""
    root = fresh_path(spark, "landed")
    items = microblog_items(ad.posts_docs(spark, sf))
    lot = F.pmod(F.xxhash64("r"), F.lit(64))
    for lang in ad.LANGS:
        mine = items.filter(F.col("brand") == lang).drop("brand")
        rows = mine.select(F.to_json(F.struct(*mine.columns)).alias("r")).withColumn("lot", lot)
        place = F.floor((F.row_number().over(Window.partitionBy("lot").orderBy("r")) - 1) / 256)
        arrays = rows.withColumn("k", place).groupBy("lot", "k").agg(F.collect_list("r").alias("rs"))
        text = F.concat(F.lit("["), F.array_join("rs", ",\n"), F.lit("]"))
        arrays.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(rj.raw_path(root, lang, "twitter"))
    found = rj.read_raw(spark, root, [*ad.LANGS, "xx"], "twitter")
    retweets = F.try_variant_get(F.col("retweetCount"), "$", "bigint")
    return found.select("brand", "text", retweets.alias("retweets"))


@query("S1_counts_as_landed", """SELECT CAST(event_id AS VARCHAR) AS id,
  CASE event_id % 5 WHEN 4 THEN 0 ELSE user_id END AS likes,
  CASE event_id % 5 WHEN 3 THEN 3000 ELSE 0 END AS retweets,
  CASE event_id % 5 WHEN 3 THEN user_id + 3000 WHEN 4 THEN 0 ELSE user_id END AS engagement
FROM events WHERE event_id % 7 <> 6""")
def _(spark, sf):
    """Counts as 12, 12.0, "12", 3e3 and null; each seventh line is broken and set aside."""
    n, id_ = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    forms = [n, F.concat(n, F.lit(".0")), F.concat(F.lit('"'), n, F.lit('"')),
             F.concat(n, F.lit(', "retweetCount": 3e3')), F.lit("null")]
    count = F.element_at(F.array(*forms), (F.col("event_id") % 5 + 1).cast("int"))
    line = F.concat(F.lit('{"id": "'), id_, F.lit('", "likeCount": '), count, F.lit("}"))
    broken = F.col("event_id") % 7 == 6
    root = fresh_path(spark, "landed")
    ad.table(spark, sf, "events").select(
        F.when(broken, F.concat(F.lit("{"), line)).otherwise(line).alias("value")
    ).write.text(rj.raw_path(root, "en", "twitter"))
    items = rj.read_raw(spark, root, ["en"], "twitter", False, quarantine=f"{root}/broken")
    return nm.NORMALISERS["twitter"](items).select("id", "likes", "retweets", "engagement")


@query("S2_raw_json_sink", with_sql("SELECT brand, platform, id, text, likes FROM pd", PD))
def _(spark, sf):
    path = fresh_path(spark, "items")
    posts = ad.posts_docs(spark, sf)
    rj.write_raw(posts.hint("rebalance", "brand", "platform"), path, ("brand", "platform"))
    back = spark.read.schema(
        "id string, text string, likes bigint, brand string, platform string").json(path)
    return back.select("brand", "platform", "id", "text", "likes")


@query("S3_unified_parquet_sink", with_sql("SELECT id, brand, text, " + DAY + " AS date FROM pd", PD))
def _(spark, sf):
    path = fresh_path(spark, "unified")
    tb.write_parquet(ad.dated_docs(spark, sf), path)
    return shown(tb.read_parquet(spark, path)).select("id", "brand", "text", "date")


LABELLED_SQL = f"""SELECT id, platform, brand, text, {DAY} AS date, url, likes, engagement,
  coalesce(strftime(date, '%B'), 'Unknown') AS month, coalesce(month(date), 0) AS month_num, bucket, bucket_label,
  confidence, {sentiment_sql(lx.NEGATIVE_WORDS, lx.POSITIVE_WORDS)} AS sentiment,
  {flag_sql(lx.COMPLAINT_WORDS)} AS is_complaint, {flag_sql(lx.ESCALATION_WORDS)} AS is_escalation FROM cl"""
LABELLED = ("id", "platform", "brand", "text", "date", "url", "likes", "engagement", "month", "month_num", "bucket",
            "bucket_label", "confidence", "sentiment", "is_complaint", "is_escalation")


def classified(spark, sf):
    return label_posts(ad.dated_docs(spark, sf), TX)


@query("S4_classified_parquet_sink", with_sql(LABELLED_SQL, PD, classify_sql(TX, "pd")))
def _(spark, sf):
    path = fresh_path(spark, "classified")
    tb.write_classified(classified(spark, sf), path)
    return shown(tb.read_parquet(spark, path)).select(*LABELLED)


def csv_round_trip(spark, sf):
    path = fresh_path(spark, "csv")
    posts = classified(spark, sf)
    columns = [f for f in S.CLASSIFIED.fields if f.name in posts.columns]
    rows = posts.select(*[f.name for f in columns])
    tb.write_csv(rows, path)
    return tb.read_csv(spark, path, type(S.CLASSIFIED)(columns))


@query("S5_csv_sink", with_sql(LABELLED_SQL, PD, classify_sql(TX, "pd")))
def _(spark, sf):
    return shown(csv_round_trip(spark, sf)).select(*LABELLED)


@query("S6_parquet_scan", "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS brand FROM orders "
       "WHERE o_orderdate >= TIMESTAMP '1996-04-01' AND o_orderdate < TIMESTAMP '1996-08-01'")
def _(spark, sf):
    posts = ad.posts_orders(spark, sf)
    return posts.filter(ad.CALENDAR.covers(F.col("date"))).select("id", "brand")


@query("S7_csv_scan", with_sql(
    f"SELECT id, brand, platform, {DAY} AS date, engagement, bucket, confidence FROM cl",
    PD, classify_sql(TX, "pd")))
def _(spark, sf):
    return shown(csv_round_trip(spark, sf)).select(
        "id", "brand", "platform", "date", "engagement", "bucket", "confidence")


@query("S7_csv_by_name", """SELECT CAST(event_id AS VARCHAR) AS id, event_type AS text, user_id AS likes,
  CAST(NULL AS VARCHAR) AS brand FROM events""")
def _(spark, sf):
    """Columns in another order, one unknown, one absent, counts written as 12.0."""
    path = fresh_path(spark, "csv")
    tb.write_csv(ad.table(spark, sf, "events").select(
        F.concat(F.col("user_id").cast("string"), F.lit(".0")).alias("likes"),
        F.lit("x").alias("unknown"), F.col("event_type").alias("text"),
        F.col("event_id").cast("string").alias("id"),
    ), path)
    return tb.read_csv(spark, path).select("id", "text", "likes", "brand")


def document_path(spark, sf):
    """Reports of the orders as one document."""
    path = fresh_path(spark, "analytics")
    posts = ad.posts_orders(spark, sf, platform=True)
    marts = flow.reports(posts, ad.PAIR, ad.ORDER_TAXONOMY, ad.CALENDAR)
    flow.write_reports(marts, path, ad.PAIR, ad.ORDER_TAXONOMY)
    return path


def written_document(spark, sf):
    return doc.read_document(spark, document_path(spark, sf))


@query("S8_analytics_doc_sink", with_sql("""SELECT sh.brand, bucket_label, count, share,
  least(count, 8) AS examples FROM sh WHERE brand <> 'P'""", PO, ad.DIMS_SQL, ad.SHARES_SQL))
def _(spark, sf):
    return doc.document_buckets(written_document(spark, sf))


@query("S9_analytics_doc_scan", with_sql("""SELECT brand, month, total, complaints, escalations,
  round_even((total - p)::DOUBLE / nullif(p, 0) * 100, 1) AS mom_total_pct FROM (
  SELECT *, lag(total) OVER (PARTITION BY brand ORDER BY month_idx) AS p FROM mt) WHERE brand <> 'P'""",
    PO, ad.DIMS_SQL, ad.MONTHLY_SQL))
def _(spark, sf):
    return doc.document_months(written_document(spark, sf))


def leaves_sql(section, path, fields, source, where="true"):
    """Rows of one section: a path and value for every field; numbers and texts apart."""
    entries = ", ".join(
        f"{{'k': '{k}', 'n': {f'CAST({k} AS DOUBLE)' if n else 'NULL'}, 't': {'NULL' if n else k}}}"
        for k, n in fields.items()
    )
    return f"""SELECT '{section}' AS section, {path} || '/' || e.k AS path, e.n AS number, e.t AS text
  FROM (SELECT *, unnest([{entries}]) AS e FROM {source} WHERE {where})"""


# Whether a field holds a number.
POST_FIELDS = {"text": 0, "platform": 0, "day": 0, "engagement": 1, "sentiment": 0, "url": 0}
MONTH_FIELDS = {"total": 1, "complaints": 1, "escalations": 1, "sentiment_neg": 1, "mom_total_pct": 1}
ISSUE_FIELDS = {
    "issue": 0, "type": 0, "total": 1, "first_count": 1, "last_count": 1, "growth_pct": 1, "brand": 0,
}
SAMPLE_FIELDS = {k: n for k, n in POST_FIELDS.items() if k not in ("sentiment", "url")}
PAIR_ONLY = "brand IN ('F', 'O')"

DOCUMENT_CTES = (
    ad.PO_SQL, ad.DIMS_SQL, ad.MONTHLY_SQL, ad.SHARES_SQL, ad.GAPS_SQL, mq.RANKED_SQL, mq.CHANGES_SQL,
    mq.TOPICS_SQL, mq.SPIKES_SQL.replace("FROM mb CROSS JOIN lp", "FROM mb CROSS JOIN lp WHERE brand <> 'P'")
    .replace("WHERE n > 0)", "WHERE n > 0 AND brand <> 'P')").replace("growth_pct > 20", "growth_pct > 50"),
    mq.EMERGING_SQL,
    f"""kp AS (SELECT brand, count(*) AS total_posts, count(*) FILTER (WHERE is_complaint) AS complaint_posts,
  count(*) FILTER (WHERE is_escalation) AS escalation_posts,
  count(*) FILTER (WHERE sentiment = 'Negative') AS negative_posts FROM po WHERE {PAIR_ONLY} GROUP BY brand)""",
    """mm AS (SELECT *, round_even((total - p)::DOUBLE / nullif(p, 0) * 100, 1) AS mom_total_pct FROM (
  SELECT *, lag(total) OVER (PARTITION BY brand ORDER BY month_idx) AS p FROM mt))""",
    """bm AS (SELECT *, round_even((n - p)::DOUBLE / nullif(p, 0) * 100, 1) AS mom_bucket_pct,
    round_even(n::DOUBLE / nullif(s, 0) * 100, 1) AS bucket_pct FROM (
  SELECT *, coalesce(lag(n) OVER (PARTITION BY brand, bucket ORDER BY month_idx), 0) AS p,
    sum(n) OVER (PARTITION BY brand, month_idx) AS s FROM mb))""",
    """mv AS (SELECT brand, first(bucket_label ORDER BY change DESC, bucket_label) AS biggest_increase,
  first(bucket_label ORDER BY change, bucket_label) AS biggest_decrease FROM ch GROUP BY brand)""",
    "pp AS (SELECT rk.*, bucket_label FROM rk JOIN bk USING (bucket) WHERE rn <= 8)",
    """no AS (SELECT br.brand, bk.bucket_label FROM br CROSS JOIN bk
  WHERE NOT EXISTS (SELECT 1 FROM po WHERE po.brand = br.brand AND po.bucket = bk.bucket))""",
    """hi AS (SELECT side, bucket_label, row_number() OVER (PARTITION BY side ORDER BY bucket_ord) - 1 AS i FROM (
  SELECT *, CASE WHEN diff_share > 2 THEN 'F' WHEN diff_share < -2 THEN 'O' END AS side FROM gp) WHERE side IS NOT NULL)""",
    """ir AS (SELECT *, row_number() OVER (ORDER BY coalesce(growth_pct, 0) DESC, type, issue) - 1 AS i FROM ei)""",
    """sm AS (SELECT ir.i, s.* FROM ir JOIN (SELECT *, strftime(date, '%Y-%m-%d %H:%M:%S') AS day, row_number() OVER (
    PARTITION BY topic_label ORDER BY engagement DESC, id) AS rn FROM po WHERE bucket = '5-LOW') s
  ON s.topic_label = ir.issue AND type = 'New Topic' WHERE rn <= 3)""",
)
DOCUMENT_ROWS = [
    f"""SELECT 'platform_counts' AS section, '/' || brand || '/' || platform AS path,
  CAST(count(*) AS DOUBLE) AS number, CAST(NULL AS VARCHAR) AS text FROM po WHERE {PAIR_ONLY} GROUP BY brand, platform""",
    leaves_sql("kpis", "'/' || brand", dict.fromkeys(
        ("total_posts", "complaint_posts", "escalation_posts", "negative_posts"), 1), "kp"),
    leaves_sql("monthly_trend", "'/' || brand || '/by_month/' || month", MONTH_FIELDS, "mm", PAIR_ONLY),
    f"""SELECT 'monthly_trend', '/' || brand || '/by_month/' || month || '/' || e.k || '/' || bucket_label, e.n, NULL
  FROM (SELECT *, unnest([{{'k': 'bucket_counts', 'n': CAST(n AS DOUBLE)}}, {{'k': 'bucket_pct', 'n': bucket_pct}},
    {{'k': 'mom_bucket_pct', 'n': mom_bucket_pct}}]) AS e FROM bm WHERE n > 0 AND {PAIR_ONLY})""",
    f"""SELECT 'monthly_trend', '/' || brand || '/by_month/' || month || '/' || k, NULL, '{{}}'
  FROM (SELECT *, unnest(['bucket_counts', 'bucket_pct', 'mom_bucket_pct']) AS k FROM mm WHERE total = 0 AND {PAIR_ONLY})""",
    leaves_sql("monthly_trend", "'/' || brand", {"biggest_increase": 0, "biggest_decrease": 0}, "mv", PAIR_ONLY),
    leaves_sql("bucket_analysis", "'/' || brand || '/' || bucket_label", {"count": 1, "share": 1}, "sh", PAIR_ONLY),
    f"""SELECT 'bucket_analysis', '/' || brand || '/' || bucket_label || '/trend/' || month, CAST(n AS DOUBLE), NULL
  FROM mb WHERE {PAIR_ONLY}""",
    leaves_sql("bucket_analysis", "'/' || brand || '/' || bucket_label || '/examples/' || (rn - 1)", POST_FIELDS, "pp",
               PAIR_ONLY),
    f"SELECT 'bucket_analysis', '/' || brand || '/' || bucket_label || '/examples', NULL, '[]' FROM no WHERE {PAIR_ONLY}",
    leaves_sql("rep_posts", "'/' || brand || '/' || bucket_label || '/' || (rn - 1)", POST_FIELDS, "pp", PAIR_ONLY),
    f"SELECT 'rep_posts', '/' || brand || '/' || bucket_label, NULL, '[]' FROM no WHERE {PAIR_ONLY}",
    """SELECT 'competitive', '/by_bucket/' || bucket_label || '/' || e.k, e.n, NULL FROM (SELECT *, unnest([
  {'k': 'F_count', 'n': CAST(a_count AS DOUBLE)}, {'k': 'O_count', 'n': CAST(b_count AS DOUBLE)},
  {'k': 'F_share', 'n': a_share}, {'k': 'O_share', 'n': b_share}, {'k': 'diff_share', 'n': diff_share}]) AS e FROM gp)""",
    "SELECT 'competitive', '/higher/' || side || '/' || i, NULL, bucket_label FROM hi",
    "SELECT 'competitive', '/higher/' || b, NULL, '[]' FROM (VALUES ('F'), ('O')) t(b) WHERE b NOT IN (SELECT side FROM hi)",
    leaves_sql("emerging", "'/' || i", ISSUE_FIELDS, "ir"),
    leaves_sql("emerging", "'/' || i || '/samples/' || (rn - 1)", SAMPLE_FIELDS, "sm"),
    "SELECT 'emerging', '/' || i || '/samples', NULL, '[]' FROM ir WHERE i NOT IN (SELECT i FROM sm)",
    "SELECT 'emerging', '', NULL, '[]' WHERE NOT EXISTS (SELECT 1 FROM ir)",
]


@query("S9_document_paths", with_sql(
    "SELECT section, regexp_replace(path, '/day$', '/date') AS path, number, text FROM (\n"
    + "\nUNION ALL ".join(DOCUMENT_ROWS) + ")", *DOCUMENT_CTES))
def _(spark, sf):
    """Every value of all seven sections."""
    return doc.document_paths(spark, document_path(spark, sf))


@query("S10_source_fallback", with_sql(
    "SELECT id, brand, 'csv' AS found FROM pd UNION ALL SELECT id, brand, 'parquet' FROM pd", PD))
def _(spark, sf):
    absent, path = fresh_path(spark, "absent"), fresh_path(spark, "unified")
    posts = ad.dated_docs(spark, sf).select("id", "platform", "brand", "text", "date")
    rows = posts.select(
        *[F.col(f.name) if f.name in posts.columns else F.lit(None).cast(f.dataType).alias(f.name)
          for f in S.CLASSIFIED.fields]
    )
    tb.write_parquet(rows, path)
    tb.write_csv(rows, path + "-csv")
    found = {
        "csv": tb.read_posts(spark, absent, path + "-csv"),
        "parquet": tb.read_posts(spark, path, path + "-csv"),
        "none": tb.read_posts(spark, absent, absent),
    }
    parts = [f.select("id", "brand", F.lit(k).alias("found")) for k, f in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("S10_whole_source", with_sql(
    """SELECT id, brand, platform, text, 'real' AS data_source FROM mi
UNION ALL SELECT id, brand, platform, text, 'synthetic' FROM fo
UNION ALL SELECT id, brand, platform, text, 'synthetic' FROM pr""", PD, MICROBLOG_SQL, FORUM_SQL, PROFESSIONAL_SQL))
def _(spark, sf):
    """One source landed whole, one half landed, one absent; all have a substitute."""
    posts = flow.materialise(ad.posts_docs(spark, sf), "to-land")
    substitute, real = land(spark, sf, posts=posts), fresh_path(spark, "real")
    complete, half, absent = ITEMS
    by_brand = {b: posts.filter(F.col("brand") == b) for b in ad.LANGS}
    cm.land_source({b: ITEMS[complete](rows).drop("brand") for b, rows in by_brand.items()}, real, complete)
    for brand, rows in list(by_brand.items())[:2]:  # no marker follows
        rj.write_raw(ITEMS[half](rows).drop("brand"), rj.raw_path(real, brand, half))
    found = [cm.posts_of(spark, real, substitute, s, ad.LANGS) for s in (complete, half, absent)]
    shown_columns = ("id", "brand", "platform", "text", "data_source")
    parts = [f.select(*shown_columns) for f in found]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("S11_landed_json_stream", with_sql(
    "SELECT id, brand, platform, text, date, likes, engagement, bucket FROM cl",
    PD, MICROBLOG_SQL, classify_sql(TX, "mi")))
def _(spark, sf):
    posts, _ = ingested(spark, sf)
    return shown(posts).select("id", "brand", "platform", "text", "date", "likes", "engagement", "bucket")


def ingested(spark, sf, delay=None):
    """All landed brands through one stream: the stored posts and the cube."""
    root = land(spark, sf, ["twitter"])
    table, state, cube = (fresh_path(spark, name) for name in ("posts", "state", "cube"))
    ld.start_ingest(
        ld.landed_brands(spark, root, "twitter"), "twitter", table, state,
        enrich=lambda posts: classify_posts(posts, TX), delay=delay, cube=cube, calendar=ad.CALENDAR,
    ).awaitTermination()
    return ld.read_ingested(spark, table), ld.read_cube(spark, cube)


@query("S11_stateful_ingest", with_sql(
    """SELECT brand, platform, md5(substring(text, 1, 200)) AS key, date IS NOT NULL AS dated,
  CASE WHEN date IS NULL THEN count(*) ELSE 1 END AS n FROM mi GROUP BY ALL""".replace(
        "GROUP BY ALL", "GROUP BY brand, platform, key, date IS NOT NULL, date IS NULL"), PD, MICROBLOG_SQL))
def _(spark, sf):
    """A delay beyond the span of all dates: one dated post of each key, all undated ones."""
    posts, _ = ingested(spark, sf, delay="36500 days")
    key = F.md5(F.substring("text", 1, 200).cast("binary"))
    dated = F.col("date").isNotNull()
    return posts.groupBy("brand", "platform", key.alias("key"), dated.alias("dated")).agg(F.count(F.lit(1)).alias("n"))


@query("S11_stream_cube", with_sql(
    """SELECT brand, platform, bucket, month_idx, count(*) AS n, CAST(sum(engagement) AS BIGINT) AS engagement_sum
FROM (SELECT *, CASE WHEN date >= '1996-04-01' AND date < '1996-08-01' THEN month(CAST(date AS TIMESTAMP)) - 4 END
  AS month_idx FROM cl) GROUP BY ALL""", PD, MICROBLOG_SQL, classify_sql(TX, "mi")))
def _(spark, sf):
    """The cube that grows with the stream: reports read it instead of the posts."""
    _, cube = ingested(spark, sf)
    return cube.select("brand", "platform", "bucket", "month_idx", "n", "engagement_sum")


# --- end to end -----------------------------------------------------------------

UNIFIED_SQL = f"""al AS (SELECT * FROM mi UNION ALL SELECT * FROM fo UNION ALL SELECT * FROM pr),
fd AS (SELECT * FROM al WHERE ({FOCUS_SQL}) AND {WINDOW_SQL.replace("date BETWEEN", "CAST(date AS TIMESTAMP) BETWEEN")}),
un AS (SELECT *, row_number() OVER (PARTITION BY brand, platform, substring(text, 1, 200)
  ORDER BY date NULLS LAST, id, text) AS rn FROM fd)"""


@query("U0_unified_posts", with_sql(
    "SELECT id, brand, platform, text, date, engagement FROM un WHERE rn = 1",
    PD, MICROBLOG_SQL, FORUM_SQL, PROFESSIONAL_SQL, UNIFIED_SQL))
def _(spark, sf):
    root = land(spark, sf)
    posts = flow.unified_posts(spark, root, RULES, ad.WINDOW, json_arrays=False)
    return shown(posts).select("id", "brand", "platform", "text", "date", "engagement")


RUN_PAIR = ("en", "fr")
RUN_LABELS = ", ".join(f"('{b.key}', '{b.label}')" for b in (*TX.buckets, TX.default))


@query("E1_whole_run", with_sql(f"""SELECT 'platform_counts' AS section, '/' || brand || '/' || replace(platform, '/', '~1') AS path,
  CAST(count(*) AS DOUBLE) AS number FROM lb GROUP BY brand, platform
UNION ALL SELECT 'kpis', '/' || brand || '/' || e.k, CAST(e.n AS DOUBLE) FROM (SELECT brand, unnest([
  {{'k': 'total_posts', 'n': count(*)}}, {{'k': 'complaint_posts', 'n': count(*) FILTER (WHERE is_complaint)}},
  {{'k': 'escalation_posts', 'n': count(*) FILTER (WHERE is_escalation)}},
  {{'k': 'negative_posts', 'n': count(*) FILTER (WHERE sentiment = 'Negative')}}]) AS e FROM lb GROUP BY brand)
UNION ALL SELECT 'bucket_analysis', '/' || brand || '/' || replace(label, '/', '~1') || '/' || e.k, e.n FROM (
  SELECT *, unnest([{{'k': 'count', 'n': CAST(c AS DOUBLE)}}, {{'k': 'share', 'n': coalesce(round_even(
    c::DOUBLE / nullif(sum(c) OVER (PARTITION BY brand), 0) * 100, 1), 0)}}]) AS e FROM ct)
UNION ALL SELECT 'topics', '/labelled', CAST(CASE WHEN count(*) < 20 THEN 0 ELSE count(*) END AS DOUBLE)
  FROM al_lb WHERE bucket = '{TX.default.key}'""",
    PD, MICROBLOG_SQL, FORUM_SQL, PROFESSIONAL_SQL, UNIFIED_SQL, "u1 AS (SELECT * FROM un WHERE rn = 1)",
    classify_sql(TX, "u1"),
    f"""al_lb AS (SELECT *, {sentiment_sql(lx.NEGATIVE_WORDS, lx.POSITIVE_WORDS)} AS sentiment,
  {flag_sql(lx.COMPLAINT_WORDS)} AS is_complaint, {flag_sql(lx.ESCALATION_WORDS)} AS is_escalation FROM cl)""",
    "lb AS (SELECT * FROM al_lb WHERE brand IN ('en', 'fr'))",
    f"""ct AS (SELECT brand, label, count(lb.id) AS c FROM (VALUES ('en'), ('fr')) t(brand)
  CROSS JOIN (VALUES {RUN_LABELS}) k(bucket, label) LEFT JOIN lb USING (brand, bucket) GROUP BY ALL)"""))
def _(spark, sf):
    """Landed items to posts, labels, topics, the stored table, the reports and the document.

    Fewer than 20 posts in the default bucket get no topics.
    """
    root, marts, path = land(spark, sf), fresh_path(spark, "marts"), fresh_path(spark, "analytics")
    posts = flow.unified_posts(spark, root, RULES, ad.WINDOW, json_arrays=False)
    tb.write_classified(flow.classified_posts(posts, TX), marts)
    stored = tb.read_posts(spark, marts)
    flow.write_reports(flow.reports(stored, RUN_PAIR, TX, ad.CALENDAR), path, RUN_PAIR, TX)
    leaves = doc.document_paths(spark, path).filter("number IS NOT NULL")
    totals = F.col("section").isin("platform_counts", "kpis")
    shares = (F.col("section") == "bucket_analysis") & F.col("path").rlike("^/[^/]*/[^/]*/(count|share)$")
    topics = stored.filter("topic_label <> ''").agg(F.count(F.lit(1)).cast("double").alias("number"))
    return leaves.filter(totals | shares).select("section", "path", "number").unionByName(
        topics.select(F.lit("topics").alias("section"), F.lit("/labelled").alias("path"), "number")
    )
