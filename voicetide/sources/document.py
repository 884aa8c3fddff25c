"""The analytics document: all reports nested in one JSON object.

Only aggregated rows and top-n posts enter it, so its size is fixed by brands,
buckets, months and n.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voicetide.config import Taxonomy
from voicetide.functions import scalars as sc
from voicetide.functions.literals import grid
from voicetide.operators.competitive import gap_list_columns

_KEEP_NULLS = {"ignoreNullFields": "false"}

POST_ENTRY = (
    "struct<text:string,platform:string,date:string,engagement:bigint,sentiment:string,url:string>"
)

#: Schema for reading the numeric sections back.
DOCUMENT = (
    "platform_counts map<string,map<string,bigint>>, "
    "kpis map<string,struct<total_posts:bigint,complaint_posts:bigint,"
    "escalation_posts:bigint,negative_posts:bigint>>, "
    "monthly_trend map<string,struct<by_month:map<string,struct<total:bigint,"
    "bucket_counts:map<string,bigint>,bucket_pct:map<string,double>,mom_total_pct:double,"
    "mom_bucket_pct:map<string,double>,complaints:bigint,escalations:bigint,"
    "sentiment_neg:bigint>>,biggest_increase:string,biggest_decrease:string>>, "
    "bucket_analysis map<string,map<string,struct<count:bigint,share:double,"
    f"trend:map<string,bigint>,examples:array<{POST_ENTRY}>>>>, "
    "competitive struct<by_bucket:map<string,map<string,double>>,higher:map<string,array<string>>>, "
    "emerging array<struct<issue:string,type:string,total:bigint,first_count:bigint,"
    "last_count:bigint,growth_pct:double,brand:string,samples:array<struct<text:string,"
    "platform:string,date:string,engagement:bigint>>>>, "
    f"rep_posts map<string,map<string,array<{POST_ENTRY}>>>"
)


def map_of(key: Column | str, value: Column) -> Column:
    """Aggregate (key, value) rows to one map; keys are unique per group."""
    return F.map_from_entries(F.collect_list(F.struct(
        (F.col(key) if isinstance(key, str) else key).alias("k"), value.alias("v")
    )))


def _section(rows: DataFrame, name: str, value: Column) -> DataFrame:
    return rows.agg(F.to_json(value, _KEEP_NULLS).alias("document")).select(
        F.lit(name).alias("section"), "document"
    )


def post_lists(posts: DataFrame, brands: Sequence[str], taxonomy: Taxonomy) -> DataFrame:
    """Ranked post lists per brand and bucket label; empty where none."""
    entry = F.struct(
        "text", "platform", sc.second_label(F.col("date")).alias("date"),
        "engagement", "sentiment", "url",
    )
    lists = posts.groupBy("brand", "bucket").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("rn", entry.alias("post")))),
            lambda e: e["post"],
        ).alias("posts")
    )
    frame = grid(posts.sparkSession, brand=brands, bucket=taxonomy.keys)
    return frame.join(lists, ["brand", "bucket"], "left").select(
        "brand",
        "bucket",
        taxonomy.label_of(F.col("bucket")).alias("bucket_label"),
        F.coalesce("posts", F.array().cast(f"array<{POST_ENTRY}>")).alias("posts"),
    )


def sections(
    marts: Mapping[str, DataFrame],
    brands: tuple[str, str],
    taxonomy: Taxonomy,
    gap_points: float = 2,
) -> DataFrame:
    """One (section, JSON text) row per report."""
    a, b = brands
    n = F.col("n")
    counts = marts["platform_counts"].groupBy("brand").agg(map_of("platform", n).alias("v"))
    kpis = marts["kpis"]
    kpi = F.struct(*[c for c in kpis.columns if c != "brand"])

    present = n > 0
    label = F.col("bucket_label")

    def present_map(value: Column) -> Column:
        rows = F.collect_list(F.when(present, F.struct(label, value.alias("v"))))
        return F.map_from_entries(rows)

    by_bucket = marts["monthly_buckets"].groupBy("brand", "month_idx", "month").agg(
        present_map(n).alias("bucket_counts"),
        present_map(F.col("bucket_pct")).alias("bucket_pct"),
        present_map(F.col("mom_bucket_pct")).alias("mom_bucket_pct"),
    )
    month = marts["monthly_totals"].join(by_bucket, ["brand", "month_idx", "month"])
    month_doc = F.struct(
        "total", "bucket_counts", "bucket_pct", "mom_total_pct", "mom_bucket_pct",
        "complaints", "escalations", "sentiment_neg",
    )
    trend = (
        month.groupBy("brand")
        .agg(map_of("month", month_doc).alias("by_month"))
        .join(marts["biggest_movers"], "brand", "left")
    )
    trend_doc = F.struct("by_month", "biggest_increase", "biggest_decrease")

    lists = post_lists(marts["top_posts"], brands, taxonomy)
    per_month = marts["monthly_buckets"].groupBy("brand", "bucket").agg(
        map_of("month", n).alias("trend")
    )
    buckets = (
        marts["bucket_shares"]
        .join(per_month, ["brand", "bucket"])
        .join(lists.drop("bucket_label"), ["brand", "bucket"])
        .groupBy("brand")
        .agg(
            map_of(
                "bucket_label",
                F.struct("count", "share", "trend", F.col("posts").alias("examples")),
            ).alias("v")
        )
    )
    gap_doc = F.create_map(
        F.lit(f"{a}_count"), F.col("a_count").cast("double"),
        F.lit(f"{b}_count"), F.col("b_count").cast("double"),
        F.lit(f"{a}_share"), F.col("a_share"),
        F.lit(f"{b}_share"), F.col("b_share"),
        F.lit("diff_share"), F.col("diff_share"),
    )
    gaps = marts["competitive"].agg(
        map_of("bucket_label", gap_doc).alias("by_bucket"), *gap_list_columns(gap_points)
    )
    higher = F.create_map(F.lit(a), F.col("higher_a"), F.lit(b), F.col("higher_b"))
    competitive = F.first(F.struct("by_bucket", higher.alias("higher")))

    issues = marts["emerging"]
    order = F.struct(
        (-F.coalesce("growth_pct", F.lit(0.0))).alias("g"), F.col("type").alias("t"),
        F.col("issue").alias("i"), F.struct(*issues.columns).alias("doc"),
    )
    emerging = F.transform(F.sort_array(F.collect_list(order)), lambda s: s["doc"])
    rep = lists.groupBy("brand").agg(map_of("bucket_label", F.col("posts")).alias("v"))

    parts = [
        _section(counts, "platform_counts", map_of("brand", F.col("v"))),
        _section(kpis, "kpis", map_of("brand", kpi)),
        _section(trend, "monthly_trend", map_of("brand", trend_doc)),
        _section(buckets, "bucket_analysis", map_of("brand", F.col("v"))),
        _section(gaps, "competitive", competitive),
        _section(issues, "emerging", emerging),
        _section(rep, "rep_posts", map_of("brand", F.col("v"))),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_document(sections_df: DataFrame, path: str) -> None:
    """One JSON object, one key per section."""
    entry = F.struct("section", F.parse_json("document").alias("v"))
    doc = sections_df.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    doc.coalesce(1).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOCUMENT).json(path)


#: Levels of nesting that ``document_paths`` follows; the deepest section has six.
DEPTH = 10


def document_paths(spark: SparkSession, path: str) -> DataFrame:
    """(section, path, number, text): every value of the document, whatever its sections.

    Read as VARIANT, so no schema is fixed.  ``path`` is a JSON pointer below the section.
    Numbers are in ``number``, all else as text; a null has neither, and an empty list or
    object is a row of its own with ``[]`` or ``{}`` as text.  Deeper nesting than
    ``DEPTH`` is an error.
    """
    rows = spark.read.text(path).select(
        F.lit("").alias("path"), F.parse_json("value").alias("v")
    )
    found = []
    for level in range(DEPTH + 1):
        kind, json = F.schema_of_variant("v"), F.to_json("v")
        plain = kind.isin("STRING", "BOOLEAN")
        nested = (kind.startswith("ARRAY") | kind.startswith("OBJECT")) & ~json.isin("[]", "{}")
        number = F.when(~plain, F.try_variant_get("v", "$", "double"))
        text = F.when(plain, F.try_variant_get("v", "$", "string")).when(json.isin("[]", "{}"), json)
        if level == DEPTH:
            deep = F.raise_error(F.concat(F.lit("nested too deep: "), "path")).cast("string")
            found.append(rows.select("path", number.alias("number"), F.when(nested, deep).otherwise(text).alias("text")))
            break
        found.append(rows.filter(~nested).select("path", number.alias("number"), text.alias("text")))
        below = rows.filter(nested).lateralJoin(
            spark.tvf.variant_explode(F.col("v").outer()).toDF("_pos", "_key", "_value")
        )
        name = F.replace(F.replace("_key", F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
        step = F.coalesce(name, F.col("_pos").cast("string"))
        rows = below.select(F.concat("path", F.lit("/"), step).alias("path"), F.col("_value").alias("v"))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    parts = F.split("path", "/", 3)
    rest = F.coalesce(F.concat(F.lit("/"), F.get(parts, F.lit(2))), F.lit(""))
    return out.select(F.get(parts, F.lit(1)).alias("section"), rest.alias("path"), "number", "text")


def document_kpis(document: DataFrame) -> DataFrame:
    return document.select(F.explode("kpis").alias("brand", "k")).select("brand", "k.*")


def document_months(document: DataFrame) -> DataFrame:
    brands = document.select(F.explode("monthly_trend").alias("brand", "t"))
    months = brands.select("brand", F.explode("t.by_month").alias("month", "m"))
    return months.select(
        "brand", "month", "m.total", "m.complaints", "m.escalations", "m.mom_total_pct"
    )


def document_buckets(document: DataFrame) -> DataFrame:
    brands = document.select(F.explode("bucket_analysis").alias("brand", "b"))
    buckets = brands.select("brand", F.explode("b").alias("bucket_label", "x"))
    return buckets.select("brand", "bucket_label", "x.count", "x.share", F.size("x.examples").alias("examples"))
