"""The test tables seen as feedback posts.

``posts_orders`` gives the metrics something to count, ``posts_docs`` gives the
text operators something to read.  Both keep every row of their main table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voicetide.config import Bucket, Calendar, Taxonomy
from voicetide.operators.normalise import add_month_columns

ORDER_BRANDS = ("F", "O", "P")
PAIR = ("F", "O")
LANGS = ("en", "fr", "de", "es")
PLATFORMS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

#: Five buckets with orders, three that stay empty, the default bucket last.
ORDER_TAXONOMY = Taxonomy(
    buckets=(
        Bucket("1-URGENT", "A. Urgent"),
        Bucket("2-HIGH", "B. High"),
        Bucket("3-MEDIUM", "C. Medium"),
        Bucket("4-NOT SPECIFIED", "D. Not Specified"),
        Bucket("E_Returns", "E. Returns"),
        Bucket("F_Rider", "F. Rider"),
        Bucket("G_Payment", "G. Payment"),
        Bucket("H_Fee", "H. Fee"),
    ),
    default=Bucket("5-LOW", "I. Low"),
)

#: Patterns that occur in the invented prose and reach every branch.
TEXT_TAXONOMY = Taxonomy(
    buckets=(
        Bucket("A_Nouns", "A. Nouns", ("tion(s|al)?",)),
        Bucket("B_Verbs", "B. Verbs", ("ing",)),
        Bucket("C_Articles", "C. Articles", ("und", "der", "die")),
        Bucket("D_Plurals", "D. Plurals", ("eaux", "ouè")),
        Bucket("E_Legal", "E. Legal", ("license", "copyright")),
        Bucket("F_Contact", "F. Contact", ("@",)),
        Bucket("G_Accent", "G. Accent", ("ción",)),
        Bucket("H_Secret", "H. Secret", ("password", "secret", "api.key")),
    ),
    default=Bucket("I_Other", "I. Other/Emerging"),
)
NEGATIVE = "worthless|wrong|nicht|sans|no |pas|sin"
POSITIVE = "good|the|les|und|los|y "
COMPLAINT = "worthless|error|license|password|éeau"
ESCALATION = "secret|copyright|@"

CALENDAR = Calendar.of(1996, (4, 5, 6, 7))
WINDOW = ("1996-04-01 00:00:00", "1999-06-30 23:59:59")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def posts_orders(spark: SparkSession, sf: str, platform: bool = False) -> DataFrame:
    """Orders as classified posts; ``platform`` adds the customer's columns."""
    orders = table(spark, sf, "orders")
    price = F.col("o_totalprice")
    posts = orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("brand"),
        F.concat(
            F.lit("order "), F.col("o_orderkey").cast("string"), F.lit(" "),
            F.lower("o_orderpriority"),
        ).alias("text"),
        F.col("o_orderdate").alias("date"),
        F.concat(F.lit("u/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.floor(price).cast("bigint").alias("engagement"),
        F.col("o_orderpriority").alias("bucket"),
        (price > 200000).alias("is_complaint"),
        (price > 450000).alias("is_escalation"),
        F.when(price > 250000, F.lit("Negative"))
        .when(price > 100000, F.lit("Neutral"))
        .otherwise(F.lit("Positive"))
        .alias("sentiment"),
        F.when(F.col("o_orderstatus") == "P", F.lit("synthetic"))
        .otherwise(F.lit("real")).alias("data_source"),
        F.col("o_custkey").alias("_cust"),
    )
    if not platform:
        return posts.drop("_cust")
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("_cust"),
        F.col("c_mktsegment").alias("platform"),
        F.col("c_nationkey").alias("_nation"),
    )
    topic = F.when(
        (F.col("bucket") == ORDER_TAXONOMY.default.key) & (F.col("_nation") > 0),
        F.concat(F.lit("topic "), F.col("_nation").cast("string")),
    ).otherwise(F.lit(""))
    joined = posts.join(customer, "_cust").withColumn("topic_label", topic)
    return joined.drop("_cust", "_nation")


PO_SQL = """po AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS brand,
    'order ' || CAST(o_orderkey AS VARCHAR) || ' ' || lower(o_orderpriority) AS text,
    o_orderdate AS date, 'u/' || CAST(o_orderkey AS VARCHAR) AS url,
    CAST(floor(o_totalprice) AS BIGINT) AS engagement, o_orderpriority AS bucket,
    o_totalprice > 200000 AS is_complaint, o_totalprice > 450000 AS is_escalation,
    CASE WHEN o_totalprice > 250000 THEN 'Negative' WHEN o_totalprice > 100000 THEN 'Neutral'
      ELSE 'Positive' END AS sentiment,
    CASE WHEN o_orderstatus = 'P' THEN 'synthetic' ELSE 'real' END AS data_source,
    c_mktsegment AS platform,
    CASE WHEN o_orderpriority = '5-LOW' AND c_nationkey > 0
      THEN 'topic ' || CAST(c_nationkey AS VARCHAR) ELSE '' END AS topic_label,
    CASE WHEN o_orderdate >= TIMESTAMP '1996-04-01' AND o_orderdate < TIMESTAMP '1996-08-01'
      THEN month(o_orderdate) - 4 END AS month_idx
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

DIMS_SQL = """br AS (SELECT * FROM (VALUES ('F'), ('O'), ('P')) t(brand)),
mo AS (SELECT * FROM (VALUES (0, 'April'), (1, 'May'), (2, 'June'), (3, 'July')) t(month_idx, month)),
bk AS (SELECT * FROM (VALUES ('1-URGENT', 'A. Urgent', 0), ('2-HIGH', 'B. High', 1),
  ('3-MEDIUM', 'C. Medium', 2), ('4-NOT SPECIFIED', 'D. Not Specified', 3),
  ('E_Returns', 'E. Returns', 4), ('F_Rider', 'F. Rider', 5), ('G_Payment', 'G. Payment', 6),
  ('H_Fee', 'H. Fee', 7), ('5-LOW', 'I. Low', 8)) t(bucket, bucket_label, bucket_ord))"""

# Dense monthly counts per brand and per brand and bucket.
MONTHLY_SQL = """mt AS (
  SELECT br.brand, mo.month_idx, mo.month, count(po.id) AS total,
    count(*) FILTER (WHERE po.is_complaint) AS complaints,
    count(*) FILTER (WHERE po.is_escalation) AS escalations,
    count(*) FILTER (WHERE po.sentiment = 'Negative') AS sentiment_neg
  FROM br CROSS JOIN mo LEFT JOIN po ON po.brand = br.brand AND po.month_idx = mo.month_idx
  GROUP BY ALL),
mb AS (
  SELECT br.brand, mo.month_idx, mo.month, bk.bucket, bk.bucket_label, bk.bucket_ord,
    count(po.id) AS n
  FROM br CROSS JOIN mo CROSS JOIN bk
  LEFT JOIN po ON po.brand = br.brand AND po.month_idx = mo.month_idx AND po.bucket = bk.bucket
  GROUP BY ALL)"""

SHARES_SQL = """sc AS (
  SELECT br.brand, bk.bucket, bk.bucket_label, bk.bucket_ord, count(po.id) AS count
  FROM br CROSS JOIN bk LEFT JOIN po ON po.brand = br.brand AND po.bucket = bk.bucket
  GROUP BY ALL),
sh AS (
  SELECT *, coalesce(round_even(count::DOUBLE /
    nullif(sum(count) OVER (PARTITION BY brand), 0) * 100, 1), 0) AS share FROM sc)"""

GAPS_SQL = """pc AS (
  SELECT bk.bucket, bk.bucket_label, bk.bucket_ord,
    count(*) FILTER (WHERE po.brand = 'F') AS a_count,
    count(*) FILTER (WHERE po.brand = 'O') AS b_count
  FROM bk LEFT JOIN po ON po.bucket = bk.bucket GROUP BY ALL),
ps AS (
  SELECT *, round_even(a_count::DOUBLE / greatest(sum(a_count) OVER (), 1) * 100, 1) AS a_share,
    round_even(b_count::DOUBLE / greatest(sum(b_count) OVER (), 1) * 100, 1) AS b_share FROM pc),
gp AS (SELECT *, round_even(a_share - b_share, 1) AS diff_share FROM ps)"""


def documents(spark: SparkSession, sf: str) -> DataFrame:
    # the file layout decides how many tasks run the regexes
    return table(spark, sf, "documents")


def posts_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as unclassified posts, dated by the order of the same number."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("doc_id"),
        F.timestamp_add("SECOND", F.col("o_orderkey"), F.col("o_orderdate")).alias("date"),
        F.floor("o_totalprice").cast("bigint").alias("engagement"),
    )
    docs = documents(spark, sf).join(orders, "doc_id", "left")
    return docs.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("platform"),
        F.col("lang").alias("brand"),
        "text",
        "date",
        F.concat(F.lit("u/"), F.col("doc_id").cast("string")).alias("url"),
        "engagement",
        F.length(F.col("source")).cast("bigint").alias("likes"),
    )


PD_SQL = """pd AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, source AS platform, lang AS brand, text,
    o_orderdate + to_seconds(o_orderkey) AS date, 'u/' || CAST(doc_id AS VARCHAR) AS url,
    CAST(floor(o_totalprice) AS BIGINT) AS engagement, length(source) AS likes
  FROM documents LEFT JOIN orders ON doc_id = o_orderkey)"""


def dated_docs(spark: SparkSession, sf: str) -> DataFrame:
    return add_month_columns(posts_docs(spark, sf))
