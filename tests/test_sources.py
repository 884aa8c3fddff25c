"""Writers and readers, the shared folder, the document and the stream."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import adapters as ad
from voicetide.config import FocusRule
from voicetide.lexicons import default_taxonomy
from voicetide.plans import flow
from voicetide.schema import CLASSIFIED
from voicetide.session import fresh_path, shared_folder
from voicetide.sources import document as doc
from voicetide.sources import raw_json as rj
from voicetide.sources import tables as tb
from voicetide.streaming import landed as ld

TEXTS = ['plain', 'line\nbreak', 'quote " and, comma', 'back\\slash "', "", "  spaces  ", "é 漢 🙂"]


def posts(spark):
    rows = [
        (str(i), "web", "x", t, datetime(2025, 5, 1, 2, 3, 4), "u", 1, 2, 3, 6, "me", "May", 5, "real",
         "A", "A. First", 0.8, "Neutral", True, False, "")
        for i, t in enumerate(TEXTS)
    ]
    rows.append(("n", "web", "x", "no date", None, *rows[0][5:]))
    return spark.createDataFrame(rows, CLASSIFIED)


def test_csv_keeps_texts(spark, tmp_path):
    path = str(tmp_path / "csv")
    tb.write_csv(posts(spark), path)
    back = tb.read_csv(spark, path)
    assert back.schema.names == CLASSIFIED.names
    assert sorted(back.collect(), key=repr) == sorted(posts(spark).collect(), key=repr)


def test_classified_is_partitioned_and_pruned(spark, tmp_path):
    path = str(tmp_path / "classified")
    tb.write_classified(posts(spark), path)
    assert (tmp_path / "classified" / "brand=x" / "month=May").is_dir()
    back = tb.read_parquet(spark, path).filter("month = 'May' and brand = 'x'")
    assert back.count() == len(TEXTS) + 1
    assert "PartitionFilters: [isnotnull(month" in back._jdf.queryExecution().toString()


def test_fallbacks(spark, tmp_path):
    absent = str(tmp_path / "absent")
    empty = tb.read_posts(spark, absent, absent)
    assert empty.count() == 0 and empty.schema.names == CLASSIFIED.names
    tb.write_csv(posts(spark), str(tmp_path / "c"))
    assert tb.read_posts(spark, absent, str(tmp_path / "c")).count() == len(TEXTS) + 1


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x").startswith(shared_folder(spark))
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_document(spark, small, tmp_path):
    path = str(tmp_path / "analytics")
    rows = ad.posts_orders(spark, small, platform=True)
    marts = flow.reports(rows, ad.PAIR, ad.ORDER_TAXONOMY, ad.CALENDAR, gap_points=1)
    flow.write_reports(marts, path, ad.PAIR, ad.ORDER_TAXONOMY, gap_points=1)
    lines = [x for f in (tmp_path / "analytics").glob("part-*") for x in f.read_text().splitlines()]
    assert len(lines) == 1
    found = json.loads(lines[0])
    assert sorted(found) == ["bucket_analysis", "competitive", "emerging", "kpis", "monthly_trend",
                             "platform_counts", "rep_posts"]
    total = rows.filter("brand = 'F'").count()
    assert found["kpis"]["F"]["total_posts"] == total
    assert sum(found["platform_counts"]["F"].values()) == total
    april = found["monthly_trend"]["F"]["by_month"]["April"]
    assert april["mom_total_pct"] is None
    assert sum(april["bucket_counts"].values()) == april["total"]
    buckets = found["bucket_analysis"]["O"]
    assert list(sorted(buckets)) == sorted(ad.ORDER_TAXONOMY.labels)
    assert buckets["E. Returns"] == {"count": 0, "share": 0.0, "examples": [],
                                     "trend": {m: 0 for m in ad.CALENDAR.names}}
    best = [p["engagement"] for p in found["rep_posts"]["F"]["A. Urgent"]]
    assert len(best) == 8 and best == sorted(best, reverse=True)
    gaps = found["competitive"]["by_bucket"]
    higher = [k for k in sorted(gaps) if gaps[k]["diff_share"] > 1]
    assert found["competitive"]["higher"]["F"] == higher
    growth = [x["growth_pct"] or 0 for x in found["emerging"]]
    assert growth == sorted(growth, reverse=True)
    topics = [x for x in found["emerging"] if x["type"] == "New Topic"]
    assert len(topics) == 5 and all(len(x["samples"]) == 3 for x in topics)
    back = doc.read_document(spark, path)
    assert doc.document_kpis(back).count() == 2
    assert doc.document_months(back).count() == 8


def test_whole_flow_from_landed_files(spark, tmp_path):
    complaints = ["Acme order cancelled, refund?", "acme chatbot loop", "Acme late delivery, hours for food"]
    items = [
        {"id": str(i), "text": f"{complaints[i % 3]} #{i}", "createdAt": f"2025-0{4 + i % 3}-02T00:00:00Z",
         "likeCount": i}
        for i in range(30)
    ]
    (tmp_path / "acme_twitter.json").write_text(json.dumps(items))
    window = ("2025-04-01 00:00:00", "2025-07-31 23:59:59")
    unified = flow.unified_posts(spark, str(tmp_path), {"acme": FocusRule("acme")}, window)
    labelled = flow.classified_posts(unified, default_taxonomy(["acme"]))
    assert sorted(labelled.columns) == sorted(CLASSIFIED.names)
    got = {r.bucket: r.n for r in labelled.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    assert got == {"A_Cancellation": 10, "B_AI_Bot": 10, "D_Delay": 10}
    assert labelled.filter("topic_label <> ''").count() == 0


def test_stream_reads_each_file_once(spark, tmp_path):
    folder = rj.raw_path(str(tmp_path / "in"), "acme", "twitter")
    table, state = str(tmp_path / "table"), str(tmp_path / "state")

    def land(name, items):
        path = f"{folder}/{name}"
        spark.createDataFrame([(json.dumps(i),) for i in items], "value string").coalesce(1).write.text(path)

    def ingest():
        items = ld.landed_items(spark, f"{folder}/*", "twitter", "acme", max_files=1)
        ld.start_ingest(items, "twitter", table, state).awaitTermination()
        return spark.read.parquet(table).select("id", "month").collect()

    land("a", [{"id": 1, "text": "one", "createdAt": "2025-05-01T00:00:00Z"}, {"id": "2", "text": "two"}])
    assert {tuple(r) for r in ingest()} == {("1", "May"), ("2", "Unknown")}
    land("b", [{"id": "3", "text": "three", "createdAt": "old"}])
    assert sorted(r.id for r in ingest()) == ["1", "2", "3"]
    assert sorted(r.id for r in ingest()) == ["1", "2", "3"]


def test_batches_are_one_scan(spark, tmp_path):
    first, second = (spark.createDataFrame([(i, "x")], "id int, text string") for i in (1, 2))
    tb.write_parquet(first, f"{tmp_path}/a")
    tb.write_parquet(second.withColumn("more", F.lit(5)), f"{tmp_path}/b")
    found = tb.read_batches(spark, [f"{tmp_path}/a", f"{tmp_path}/absent", f"{tmp_path}/b"])
    assert sorted(tuple(r) for r in found.select("id", "more").collect() if r.more) == [(2, 5)] and found.count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    assert tb.read_batches(spark, [f"{tmp_path}/absent"]).count() == 0
