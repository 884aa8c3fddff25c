"""Classification, filters, dedup, unions and topics over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import adapters as ad
from checks.registry import query, with_sql
from voicetide import lexicons as lx
from voicetide.config import FocusRule
from voicetide.functions import regexes as rx
from voicetide.functions import scalars as sc
from voicetide.operators import classify as cl
from voicetide.operators import dedup as dd
from voicetide.operators import filters as fl
from voicetide.operators import frequent as fr
from voicetide.operators import joins as jn
from voicetide.operators import topics as tp
from voicetide.operators import topn as tn
from voicetide.operators import unions as un
from voicetide.operators.normalise import available_columns, tag_source
from voicetide.session import fresh_path, materialise
from voicetide.sources import key_index as ki
from voicetide.sources import tables as tb

PD = ad.PD_SQL
TX = ad.TEXT_TAXONOMY
DEFAULT_TX = lx.default_taxonomy(["acme", "globex"])


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def hits_sql(pattern: str, column: str = "text") -> str:
    return f"len(regexp_extract_all({column}, {quoted('(?i)' + pattern)}))"


def classify_sql(taxonomy, source: str = "documents") -> str:
    """CTE ``cl``: the source rows with bucket, label and confidence."""
    counts = ", ".join(
        f"{hits_sql('|'.join(b.patterns))} AS h{i}" for i, b in enumerate(taxonomy.buckets)
    )
    names = [f"h{i}" for i in range(len(taxonomy.buckets))]
    matched = " + ".join(f"CAST({h} > 0 AS INTEGER)" for h in names)
    picks = " ".join(
        f"WHEN {h} = best THEN {quoted(b.key)}" for h, b in zip(names, taxonomy.buckets)
    )
    labels = " ".join(
        f"WHEN {quoted(b.key)} THEN {quoted(b.label)}" for b in taxonomy.all_buckets
    )
    return f"""h AS (SELECT *, {counts} FROM {source}),
hb AS (SELECT *, greatest({', '.join(names)}) AS best, {matched} AS matched FROM h),
cl0 AS (SELECT *, CASE WHEN best = 0 THEN {quoted(taxonomy.default.key)} {picks} END AS bucket,
  CASE WHEN matched = 0 THEN 0.5 WHEN matched = 1 THEN 1.0 ELSE 0.8 END::DOUBLE AS confidence FROM hb),
cl AS (SELECT *, CASE bucket {labels} END AS bucket_label FROM cl0)"""


def sentiment_sql(negative: str, positive: str) -> str:
    neg, pos = hits_sql(negative), hits_sql(positive)
    return (
        f"CASE WHEN {neg} > {pos} THEN 'Negative' WHEN {pos} > {neg} THEN 'Positive' "
        "ELSE 'Neutral' END"
    )


def flag_sql(pattern: str) -> str:
    return f"regexp_matches(text, {quoted('(?i)' + pattern)})"


# --- classification ---------------------------------------------------------

@query("X1_classify_text", with_sql(
    "SELECT doc_id, bucket, confidence FROM cl", classify_sql(TX)))
def _(spark, sf):
    docs = ad.documents(spark, sf).select("doc_id", "text")
    return cl.classify_posts(docs, TX).select("doc_id", "bucket", "confidence")


@query("X2_classify_df", with_sql(
    "SELECT doc_id, lang, bucket, bucket_label, confidence FROM cl", classify_sql(DEFAULT_TX)))
def _(spark, sf):
    docs = ad.documents(spark, sf).select("doc_id", "lang", "text")
    return cl.classify_posts(docs, DEFAULT_TX).drop("text")


@query("X3_sentiment", with_sql(f"""SELECT doc_id,
  {sentiment_sql(lx.NEGATIVE_WORDS, lx.POSITIVE_WORDS)} AS default_sentiment,
  {sentiment_sql(ad.NEGATIVE, ad.POSITIVE)} AS sentiment FROM documents"""))
def _(spark, sf):
    docs = ad.documents(spark, sf).select("doc_id", "text")
    first = cl.add_sentiment(docs).withColumnRenamed("sentiment", "default_sentiment")
    return cl.add_sentiment(first, negative=ad.NEGATIVE, positive=ad.POSITIVE).drop("text")


@query("X4_flags", with_sql(f"""SELECT doc_id, {flag_sql(lx.COMPLAINT_WORDS)} AS default_complaint,
  {flag_sql(lx.ESCALATION_WORDS)} AS default_escalation,
  {flag_sql(ad.COMPLAINT)} AS is_complaint, {flag_sql(ad.ESCALATION)} AS is_escalation
FROM documents"""))
def _(spark, sf):
    docs = ad.documents(spark, sf).select("doc_id", "text")
    first = cl.add_flags(docs).withColumnsRenamed(
        {"is_complaint": "default_complaint", "is_escalation": "default_escalation"}
    )
    return cl.add_flags(first, complaint=ad.COMPLAINT, escalation=ad.ESCALATION).drop("text")


COMPILED = ("cancell?ed", "no (human|agent)", "auto.cancel", "the", "those", "thes", "[x-z]un")


@query("X5_compile_lexicon", f"SELECT doc_id, {hits_sql('|'.join(COMPILED))} AS hits FROM documents")
def _(spark, sf):
    docs = ad.documents(spark, sf)
    text = F.col("text")
    return docs.select("doc_id", rx.count_hits(text, rx.fold(text), "|".join(COMPILED)).alias("hits"))


@query("X6_lower_contains", """SELECT doc_id, contains(lower(text), 'und') AS has_und,
  contains(lower(text), 'é') AS has_accent FROM documents""")
def _(spark, sf):
    docs = ad.documents(spark, sf)
    return docs.select(
        "doc_id",
        fl.contains_word(F.col("text"), "UND").alias("has_und"),
        fl.contains_word(F.col("text"), "É").alias("has_accent"),
    )


# --- topics -----------------------------------------------------------------

def tfidf_sql(stop_words) -> str:
    """CTEs up to ``tf``: (doc_id, lang, term, weight) with unit length per document."""
    stop = ", ".join(quoted(w) for w in stop_words)
    return f"""tk AS (SELECT doc_id, lang, list_filter(regexp_extract_all(lower(text),
    '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda w: w NOT IN ({stop})) AS w FROM documents),
tm AS (SELECT doc_id, lang, unnest(w) AS term FROM tk
  UNION ALL SELECT doc_id, lang, unnest(list_transform(list_zip(w[:-2], w[2:]),
    lambda p: p[1] || ' ' || p[2])) FROM tk WHERE len(w) > 1),
vc AS (SELECT term, count(*) AS n FROM tm GROUP BY term ORDER BY n DESC, term LIMIT 500),
dt AS (SELECT doc_id, lang, term, count(*) AS tf FROM tm WHERE term IN (SELECT term FROM vc)
  GROUP BY ALL),
nd AS (SELECT count(*) AS docs FROM documents),
df AS (SELECT term, ln((1 + any_value(docs)) / (1 + count(*))) + 1 AS idf FROM dt CROSS JOIN nd
  GROUP BY term),
wt AS (SELECT doc_id, lang, term, tf * idf AS w FROM dt JOIN df USING (term)),
tf AS (SELECT doc_id, lang, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight
  FROM wt)"""


# A short stop list that occurs in the invented prose.
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "le", "la", "de", "und", "der", "die", "el")


@query("X7_tfidf", with_sql(
    "SELECT doc_id, term, round_even(weight, 6) AS weight FROM tf", tfidf_sql(STOP_WORDS)))
def _(spark, sf):
    docs = ad.documents(spark, sf).select("doc_id", "text")
    model, vectors = tp.fit_transform(docs, keep=["doc_id"], stop_words=STOP_WORDS)
    rows = tp.weight_rows(model, materialise(vectors, "vectors"), "doc_id")
    return rows.withColumn("weight", F.bround("weight", 6))


@query("T2_frequent_labels", with_sql("""SELECT * FROM (SELECT 'words' AS kind, term AS label, count(*) AS n FROM (
    SELECT unnest(w) AS term FROM tk) GROUP BY term ORDER BY n DESC, label LIMIT 20)
UNION ALL SELECT * FROM (SELECT 'customers', CAST(o_custkey AS VARCHAR) AS label, count(*) AS n FROM orders
  GROUP BY o_custkey ORDER BY n DESC, label LIMIT 20)""", tfidf_sql(STOP_WORDS).split(",\ntm AS")[0]))
def _(spark, sf):
    """The most frequent of very many labels: skewed ones (words) and flat ones (customers)."""
    docs = ad.documents(spark, sf)
    words = docs.select(F.explode_outer(tp.words(F.col("text"), STOP_WORDS)).alias("label"))
    customers = ad.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("label"))
    parts = [
        fr.top_labels(rows, "label", 20).select(F.lit(kind).alias("kind"), "label", "n")
        for kind, rows in (("words", words), ("customers", customers))
    ]
    return parts[0].unionByName(parts[1])


@query("X8_kmeans_topics")
def _(spark, sf):
    docs = ad.documents(spark, sf).select("doc_id", "text")
    model, vectors = tp.fit_topic_vectors(docs, docs.count(), keep=["doc_id"])
    found = model.clusters.transform(vectors).select("doc_id", F.col("_cluster").alias("cluster"))
    return materialise(found, "clusters")


@query("X8_cluster_counts", """SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_docs,
  least(10, count(*) // 5 + 1) AS n_clusters, CAST(0 AS BIGINT) AS n_outside FROM documents""")
def _(spark, sf):
    """Every document in one cluster, no cluster empty, their number as the rule has it."""
    docs = ad.documents(spark, sf).select("doc_id", "text")
    model, vectors = tp.fit_topic_vectors(docs, docs.count(), keep=["doc_id"])
    found = materialise(model.clusters.transform(vectors).select("doc_id", "_cluster"), "clusters")
    inside = F.col("_cluster").between(0, len(model.labels) - 1)
    return found.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("doc_id").alias("n_docs"),
        F.countDistinct("_cluster").alias("n_clusters"), F.count_if(~inside).alias("n_outside"),
    )


@query("X9_topic_labels", with_sql("""SELECT lang, string_agg(term, '_' ORDER BY rn) AS topic_label
FROM (SELECT lang, term, row_number() OVER (PARTITION BY lang ORDER BY round_even(s / n, 9) DESC, term)
    AS rn FROM (SELECT lang, term, sum(weight) AS s FROM tf GROUP BY ALL)
  JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY lang) USING (lang))
WHERE rn <= 3 GROUP BY lang""", tfidf_sql(STOP_WORDS)))
def _(spark, sf):
    docs = ad.documents(spark, sf).select("lang", "text")
    model, vectors = tp.fit_transform(docs, keep=["lang"], stop_words=STOP_WORDS)
    return materialise(tp.cluster_terms(vectors, "lang", model.terms), "labels")


@query("X10_topic_guard", with_sql(
    "SELECT doc_id, bucket, '' AS topic_label FROM cl", classify_sql(TX)))
def _(spark, sf):
    # A minimum above the number of posts closes the guard at every scale.
    docs = ad.documents(spark, sf).select("doc_id", "text")
    posts = cl.classify_posts(docs, TX)
    guarded = tp.detect_topics(posts, TX.default.key, min_posts=docs.count() + 1)
    return guarded.select("doc_id", "bucket", "topic_label")


@query("X11_detect_emerging_topics")
def _(spark, sf):
    docs = ad.documents(spark, sf).select("doc_id", "text")
    posts = materialise(cl.classify_posts(docs, DEFAULT_TX), "classified", ["bucket"])
    found = tp.detect_topics(posts, DEFAULT_TX.default.key)
    return materialise(found.select("doc_id", "bucket", "topic_label"), "topics")


@query("X11_topic_scope", with_sql(
    "SELECT doc_id, bucket, bucket = 'I_Other' AS has_topic, bucket = 'I_Other' AS known FROM cl",
    classify_sql(TX)))
def _(spark, sf):
    """The open side of the guard: a label of the model on every post of the default
    bucket, none elsewhere."""
    docs = ad.documents(spark, sf).select("doc_id", "text")
    posts = materialise(cl.classify_posts(docs, TX), "classified", ["bucket"])
    found = materialise(tp.detect_topics(posts, TX.default.key, min_posts=1).drop("text"), "topics")
    # labels are made of three terms; a model without terms says misc
    known = F.col("topic_label").rlike("^[^_]+_[^_]+_[^_]+$") | (F.col("topic_label") == "misc")
    return found.select("doc_id", "bucket", (F.col("topic_label") != "").alias("has_topic"), known.alias("known"))


@query("X12_full_shuffle", """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS brand,
  md5(CAST(o_orderkey AS VARCHAR) || '/42') AS place FROM orders""")
def _(spark, sf):
    shuffled = tn.seeded_shuffle(ad.posts_orders(spark, sf).select("id", "brand"))
    return shuffled.withColumn("place", tn.shuffle_place())


# --- filters ----------------------------------------------------------------

RULES = {
    "en": FocusRule("the", ("worthless", "license"), ("copyright", "password")),
    "fr": FocusRule("les", ("éeau",), ("pour",)),
    "de": FocusRule("und"),
}


def focus_sql(rule: FocusRule) -> str:
    def has(word):
        return f"contains(lower(text), {quoted(word)})"

    off = " OR ".join(has(w) for w in rule.excluded) or "false"
    rescue = " OR ".join(has(w) for w in rule.rescue) or "false"
    return f"({has(rule.keyword)} AND NOT (({off}) AND NOT ({rescue})))"


FOCUS_SQL = " OR ".join(f"(brand = '{b}' AND {focus_sql(r)})" for b, r in RULES.items())


@query("F1_focus_filter", with_sql(f"SELECT id, brand FROM pd WHERE {FOCUS_SQL}", PD))
def _(spark, sf):
    return fl.focus_filter(ad.posts_docs(spark, sf), RULES).select("id", "brand")


@query("F2_contains_filter", with_sql(
    "SELECT id, brand FROM pd WHERE contains(lower(text), 'und')", PD))
def _(spark, sf):
    return fl.keyword_filter(ad.posts_docs(spark, sf), "Und").select("id", "brand")


WINDOW_SQL = (
    f"(date IS NULL OR date BETWEEN TIMESTAMP '{ad.WINDOW[0]}' AND TIMESTAMP '{ad.WINDOW[1]}')"
)


@query("F3_date_window_keep_null", with_sql(
    f"SELECT id, strftime(date, '%Y-%m-%d') AS date FROM pn WHERE {WINDOW_SQL}",
    PD, "pn AS (SELECT * REPLACE (CASE WHEN brand = 'es' THEN NULL ELSE date END AS date) FROM pd)"))
def _(spark, sf):
    posts = ad.posts_docs(spark, sf)
    some_null = posts.withColumn("date", F.when(F.col("brand") != "es", F.col("date")))
    kept = fl.date_window(some_null, *ad.WINDOW)
    return kept.select("id", sc.day_label(F.col("date")).alias("date"))


@query("F6_keyword_and_date", with_sql(
    f"SELECT id, brand FROM pd WHERE contains(lower(text), 'the') AND {WINDOW_SQL}", PD))
def _(spark, sf):
    return fl.keyword_in_window(ad.posts_docs(spark, sf), "the", *ad.WINDOW).select("id", "brand")


EMPTY_COLUMNS = (
    "id string, platform string, brand string, text string, date timestamp_ntz, url string, "
    "engagement bigint, likes bigint"
)


@query("F10_empty_guard", with_sql(f"""SELECT 'text' AS missing, count(*) AS posts,
  '{EMPTY_COLUMNS}' AS columns FROM pd WHERE text IS NULL
  UNION ALL SELECT 'keyword', count(*), '{EMPTY_COLUMNS}' FROM pd
  WHERE contains(lower(text), 'no such keyword')""", PD))
def _(spark, sf):
    posts = ad.posts_docs(spark, sf)

    def through(empty, missing):
        found = dd.dedup_prefix(fl.date_window(fl.focus_filter(empty, RULES), *ad.WINDOW))
        columns = ", ".join(f"{name} {kind}" for name, kind in found.dtypes)
        return found.agg(
            F.lit(missing).alias("missing"), F.count(F.lit(1)).alias("posts"),
            F.lit(columns).alias("columns"),
        )

    no_text = through(posts.filter(F.col("text").isNull()), "text")
    no_word = through(fl.keyword_filter(posts, "No such keyword"), "keyword")
    return no_text.unionByName(no_word)


# --- dedup, unions, joins -----------------------------------------------------

@query("D1_dedup_prefix", with_sql("""SELECT id, brand FROM (SELECT *, row_number() OVER (
  PARTITION BY brand, substring(text, 1, 200) ORDER BY date NULLS LAST, id) AS rn FROM pd)
WHERE rn = 1""", PD))
def _(spark, sf):
    return dd.dedup_prefix(ad.posts_docs(spark, sf), scope=("brand",)).select("id", "brand")


@query("D1_dedup_across_batches", with_sql("""SELECT id, brand FROM (SELECT *, row_number() OVER (
  PARTITION BY brand, substring(text, 1, 200) ORDER BY date NULLS LAST, id) AS rn FROM pd)
WHERE rn = 1""", PD))
def _(spark, sf):
    """Three batches in the order of dates, the last one undated, each against the key index only."""
    posts = materialise(ad.posts_docs(spark, sf), "to-batch")
    early = F.col("date") < F.lit("1995-01-01").cast("timestamp_ntz")
    batches = [early, ~early, F.col("date").isNull()]
    keys = [F.col("brand"), F.substring("text", 1, dd.PREFIX_LENGTH)]
    order = [F.col("date").asc_nulls_last(), F.col("id")]
    index = fresh_path(spark, "key-index")
    kept = [ki.keep_new(posts.filter(b), keys, order, index, i) for i, b in enumerate(batches)]
    return kept[0].unionByName(kept[1]).unionByName(kept[2]).select("id", "brand")


@query("D2_dedup_key_chain", """SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY CASE
  WHEN event_type = 'click' THEN 'u/' || CAST(user_id AS VARCHAR)
  WHEN event_type = 'view' THEN CAST(user_id AS VARCHAR)
  ELSE '{"url":"","id":"","kind":"' || event_type || '","props":"' || replace(props, '"', '\\"') || '"}'
  END ORDER BY event_id) AS rn FROM events) WHERE rn = 1""")
def _(spark, sf):
    events = ad.table(spark, sf, "events")
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    items = events.select(
        F.when(kind == "click", F.concat(F.lit("u/"), user)).otherwise("").alias("url"),
        F.when(kind == "view", user).otherwise("").alias("id"),
        kind.alias("kind"),
        "props",
        "event_id",
    )
    keyed = items.withColumn("_key", dd.record_key(items.drop("event_id")))
    return dd.keep_first(keyed, [F.col("_key")], [F.col("event_id")]).select("event_id")


@query("U1_union_platforms_brands", """SELECT lang AS brand, CAST(doc_id AS VARCHAR) AS id FROM documents
UNION ALL SELECT o_orderstatus, CAST(o_orderkey AS VARCHAR) FROM orders
UNION ALL SELECT role, CAST(conv_id AS VARCHAR) FROM conversations""")
def _(spark, sf):
    docs = ad.table(spark, sf, "documents").select(
        F.col("lang").alias("brand"), F.col("doc_id").cast("string").alias("id"))
    chats = ad.table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("id"), F.col("role").alias("brand"))
    orders = ad.posts_orders(spark, sf).select("id", "brand")
    return un.union_all([docs, orders, chats])


@query("U2_union_diff_schema", """SELECT CAST(doc_id AS VARCHAR) AS id, lang AS brand, 'real' AS data_source,
  NULL::BIGINT AS engagement FROM documents
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_orderstatus, 'synthetic',
  CAST(floor(o_totalprice) AS BIGINT) FROM orders""")
def _(spark, sf):
    docs = tag_source(
        ad.table(spark, sf, "documents").select(
            F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("brand")), "real")
    orders = tag_source(ad.posts_orders(spark, sf).select("id", "brand", "engagement"), "synthetic")
    return un.union_missing([docs, orders])


@query("U3_accumulate_batches", """SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids,
  count(*) FILTER (event_id % 4 = 3) AS flagged FROM events GROUP BY event_type""")
def _(spark, sf):
    """Batches by digits of the id, stored apart and read in one scan; one has a column more, one is absent."""
    events = ad.table(spark, sf, "events").select("event_id", "event_type")
    part = F.coalesce(F.col("event_id") % 4, F.lit(0))
    paths = [fresh_path(spark, f"batch{k}") for k in range(5)]
    for k, path in enumerate(paths[:4]):
        batch = events.filter(part == k)
        tb.write_parquet(batch.withColumn("flag", F.lit(1)) if k == 3 else batch, path)
    return tb.read_batches(spark, paths).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.count("flag").alias("flagged"))


@query("U4_first_non_empty", """SELECT coalesce(c.k, d.k, o.k) AS id,
  CASE WHEN c.k IS NOT NULL THEN 'chat' WHEN d.k IS NOT NULL THEN 'document' ELSE 'order' END AS found
FROM (SELECT DISTINCT CAST(conv_id AS VARCHAR) AS k FROM conversations) c
FULL JOIN (SELECT CAST(doc_id AS VARCHAR) AS k FROM documents) d ON c.k = d.k
FULL JOIN (SELECT CAST(o_orderkey AS VARCHAR) AS k FROM orders) o ON coalesce(c.k, d.k) = o.k""")
def _(spark, sf):
    def keyed(name, key, found):
        rows = ad.table(spark, sf, name)
        return rows.select(F.col(key).cast("string").alias("id"), F.lit(found).alias("found"))

    return un.first_non_empty(
        [
            keyed("conversations", "conv_id", "chat"),
            keyed("documents", "doc_id", "document"),
            keyed("orders", "o_orderkey", "order"),
        ],
        "id",
    )


@query("J1_topic_left_join", """SELECT doc_id, coalesce('q' || CAST(quality AS VARCHAR), '') AS topic_label
FROM documents LEFT JOIN labels USING (doc_id)""")
def _(spark, sf):
    topics = ad.table(spark, sf, "labels").select(
        "doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("topic_label"))
    docs = ad.table(spark, sf, "documents").select("doc_id")
    return jn.attach_topics(docs, topics, "doc_id")


# --- projections on texts -----------------------------------------------------

@query("P11_fill_null_text", """SELECT doc_id, length(CASE WHEN lang = 'fr' THEN '' ELSE text END) AS n
FROM documents""")
def _(spark, sf):
    docs = ad.table(spark, sf, "documents")
    text = F.when(F.col("lang") != "fr", F.col("text"))
    return docs.select("doc_id", F.length(sc.fill_text(text)).alias("n"))


@query("P14_available_columns", "SELECT doc_id, lang, n_chars FROM documents")
def _(spark, sf):
    docs = ad.table(spark, sf, "documents")
    return available_columns(docs, ["doc_id", "absent", "lang", "month", "n_chars"])


@query("P15_snippet", """SELECT doc_id, substring(text, 1, 300) AS long_snippet,
  substring(text, 1, 180) AS short_snippet FROM documents""")
def _(spark, sf):
    docs = ad.table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        sc.snippet(F.col("text"), 300).alias("long_snippet"),
        sc.snippet(F.col("text"), 180).alias("short_snippet"),
    )
