"""Landed JSON to posts: every fallback and type."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from voicetide.config import FocusRule
from voicetide.functions import scalars as sc
from voicetide.functions import timestamps as ts
from voicetide.operators import normalise as nm
from voicetide.plans import flow
from voicetide.sources import raw_json as rj

STAMP = datetime(2025, 1, 2, 3, 4, 5)


def land(root, brand, source, items):
    with open(rj.raw_path(str(root), brand, source), "w", encoding="utf-8") as out:
        json.dump(items, out, ensure_ascii=False)


def read(spark, root, source, brands=("acme",)):
    return rj.read_raw(spark, str(root), brands, source)


def test_microblog(spark, tmp_path):
    land(tmp_path, "acme", "twitter", [
        {"id": 5, "text": "a", "createdAt": 1735787045, "url": "u1", "likeCount": 2,
         "retweetCount": 3, "replyCount": 4, "author": {"userName": "ann"}},
        {"id_str": "s", "text": "", "full_text": "b", "created_at": "Thu Jan 02 03:04:05 +0000 2025",
         "tweetUrl": "u2", "favorite_count": 7, "retweet_count": 8, "user": {"screen_name": "bob"}},
        {"id": "", "text": None, "full_text": "", "rawContent": "c", "createdAt": 0,
         "created_at": "2025-01-02", "likeCount": 0, "favorite_count": 9, "author": None},
        {"author": {"userName": ""}, "user": {"screen_name": "eve"}, "createdAt": "garbage"},
        {"author": "plain"},
    ])
    got = nm.normalise_microblog(read(spark, tmp_path, "twitter")).collect()
    assert [r.id for r in got] == ["5", "s", "", "", ""]
    assert [r.text for r in got] == ["a", "b", "c", "", ""]
    assert [r.date for r in got] == [STAMP, STAMP, datetime(2025, 1, 2), None, None]
    assert [r.url for r in got] == ["u1", "u2", "", "", ""]
    assert [(r.likes, r.retweets, r.replies) for r in got][:3] == [(2, 3, 4), (7, 8, 0), (9, 0, 0)]
    assert [r.engagement for r in got] == [9, 0, 0, 0, 0]
    assert [r.author for r in got] == ["ann", "bob", "", "eve", ""]
    assert {r.platform for r in got} == {"Twitter/X"} and {r.brand for r in got} == {"acme"}


def test_forum(spark, tmp_path):
    land(tmp_path, "acme", "reddit", [
        {"id": "1", "title": "T", "body": "B", "createdAt": "2025-01-02T03:04:05.000Z",
         "score": 2, "numComments": 3, "author": "ann", "url": "u"},
        {"id": "2", "title": "only title", "created_utc": 1735787045.0, "ups": 4, "num_comments": 5,
         "permalink": "p"},
        {"id": "3", "selftext": "  self\n", "createdAt": "1735787045"},
        {"id": "4", "text": "t"},
    ])
    got = nm.normalise_forum(read(spark, tmp_path, "reddit")).collect()
    assert [r.text for r in got] == ["T B", "only title only title", "self", "t"]
    assert [r.date for r in got] == [STAMP, STAMP, None, None]
    assert [(r.likes, r.retweets, r.replies, r.engagement) for r in got] == [
        (2, 0, 3, 5), (4, 0, 5, 0), (0, 0, 0, 0), (0, 0, 0, 0)]
    assert [r.url for r in got] == ["u", "p", "", ""]
    assert [r.author for r in got] == ["ann", "", "", ""]


def test_professional(spark, tmp_path):
    land(tmp_path, "acme", "linkedin", [
        {"id": "1", "text": "a", "postedAt": "2025-01-02T03:04:05Z", "totalReactionCount": 2,
         "repostCount": 3, "commentsCount": 4, "author": {"name": "ann"}},
        {"urn": "u", "commentary": "b", "publishedAt": "2025-01-02T08:34:05+05:30", "likes": 5,
         "comments": 6, "authorName": "bob", "postUrl": "p"},
        {"content": "c", "date": "Jan 2, 2025"},
        {"body": "d"},
    ])
    got = nm.normalise_professional(read(spark, tmp_path, "linkedin")).collect()
    assert [r.id for r in got] == ["1", "u", "", ""]
    assert [r.text for r in got] == ["a", "b", "c", "d"]
    assert [r.date for r in got] == [STAMP, STAMP, datetime(2025, 1, 2), None]
    assert [(r.likes, r.retweets, r.replies, r.engagement) for r in got][:2] == [
        (2, 3, 4, 6), (5, 0, 6, 0)]
    assert [r.author for r in got] == ["ann", "bob", "", ""]


def test_missing_file_and_brand_names(spark, tmp_path):
    land(tmp_path, "acme", "reddit", [{"id": "1", "title": "x"}])
    land(tmp_path, "big_acme", "reddit", [{"id": "2", "title": "y"}])
    items = read(spark, tmp_path, "reddit", ["acme", "big_acme", "absent"])
    assert {(r.brand, r.title) for r in items.collect()} == {("acme", "x"), ("big_acme", "y")}
    none = read(spark, tmp_path, "twitter", ["absent"])
    assert nm.normalise_microblog(none).count() == 0
    assert nm.normalise_microblog(none).schema["date"].dataType.simpleString() == "timestamp_ntz"


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
@pytest.mark.parametrize("text, expected", [
    ("2025-01-02T03:04:05.250Z", datetime(2025, 1, 2, 3, 4, 5, 250000)),
    ("2025-01-02T03:04:05Z", STAMP),
    ("2025-01-02T03:04:05", STAMP),
    ("2025-01-02 03:04:05", STAMP),
    ("2025-01-02", datetime(2025, 1, 2)),
    ("2025-01-02T08:34:05+05:30", STAMP),
    ("Thu Jan 02 03:04:05 +0000 2025", STAMP),
    ("Thu Jan 02 04:04:05 +0100 2025", STAMP),
    ("Thu, 02 Jan 2025 03:04:05 GMT", STAMP),
    ("2 Jan 2025", datetime(2025, 1, 2)),
    ("January 2, 2025", datetime(2025, 1, 2)),
    ("Jan 2, 2025 03:04:05", STAMP),
    ("2025/1/2", datetime(2025, 1, 2)),
    ("1/2/2025", datetime(2025, 1, 2)),
    ("1735787045", None),
    ("yesterday", None),
    ("", None),
    (None, None),
])
def test_timestamp_texts(spark, zone, text, expected):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(text,)], "v string")
        assert rows.select(ts.text_to_utc(F.col("v"))).first()[0] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_epochs_out_of_range(spark):
    rows = spark.createDataFrame([(1735787045.5,), (1e18,), (-1e18,), (None,)], "v double")
    got = [r[0] for r in rows.select(ts.epoch_to_utc(F.col("v"))).collect()]
    assert got == [datetime(2025, 1, 2, 3, 4, 5, 500000), None, None, None]


def test_unified_posts(spark, tmp_path):
    day = "2025-05-01T00:00:00Z"
    land(tmp_path, "acme", "twitter", [
        {"id": "1", "text": "Acme late", "createdAt": day},
        {"id": "2", "text": "Acme late", "createdAt": "2025-04-30T00:00:00Z"},
        {"id": "3", "text": "Acme late"},
        {"id": "4", "text": "acme garden shop", "createdAt": day},
        {"id": "5", "text": "acme garden order", "createdAt": day},
        {"id": "6", "text": "unrelated", "createdAt": day},
        {"id": "7", "text": "acme old", "createdAt": "2024-05-01T00:00:00Z"},
        {"id": "8", "text": "acme undated"},
        {"id": "9", "text": "acme " + "x" * 300 + "1", "createdAt": day},
        {"id": "10", "text": "acme " + "x" * 300 + "2", "createdAt": day},
    ])
    land(tmp_path, "acme", "reddit", [{"id": "1", "title": "Acme", "body": "late"}])
    land(tmp_path, "globex", "twitter", [{"id": "1", "text": "Globex garden", "createdAt": day}])
    rules = {
        "acme": FocusRule("acme", ("garden",), ("order",)),
        "globex": FocusRule("globex"),
    }
    window = ("2025-04-01 00:00:00", "2025-07-31 23:59:59")
    posts = flow.unified_posts(spark, str(tmp_path), rules, window)
    got = {(r.brand, r.platform, r.id, r.month, r.month_num) for r in posts.collect()}
    assert got == {
        ("acme", "Twitter/X", "2", "April", 4),
        ("acme", "Twitter/X", "5", "May", 5),
        ("acme", "Twitter/X", "8", "Unknown", 0),
        ("acme", "Twitter/X", "10", "May", 5),
        ("acme", "Reddit", "1", "Unknown", 0),
        ("globex", "Twitter/X", "1", "May", 5),
    }
    from voicetide.schema import POST

    assert sorted(posts.columns) == sorted(POST.names)


def test_number_label_and_snippets(spark):
    rows = spark.createDataFrame([("1234567",), ("n/a",), (None,)], "v string")
    assert [r[0] for r in rows.select(sc.number_label(F.col("v"))).collect()] == [
        "1,234,567", "n/a", None]
    rows = spark.createDataFrame([(12.9,)], "v double")
    assert rows.select(sc.number_label(F.col("v"))).first()[0] == "12"
    growth = spark.createDataFrame([(12.5,), (-3.0,), (0.0,), (None,)], "g double")
    assert [r[0] for r in growth.select(sc.growth_label(F.col("g"))).collect()] == [
        "+12.5% MoM", "-3.0% MoM", "New", "New"]


@pytest.mark.parametrize(("text", "want"), [
    ("2025-04-01 12:00 PM", "2025-04-01 12:00:00"), ("Apr 1, 2025 3:04 PM", "2025-04-01 15:04:00"),
    ("April 1, 2025 3:04:05 am", "2025-04-01 03:04:05"), ("4/1/2025 11:30 PM", "2025-04-01 23:30:00"),
    ("1 April 2025", "2025-04-01 00:00:00"), ("20250401", "2025-04-01 00:00:00"), ("2025-04", "2025-04-01 00:00:00"),
    ("April 2025", "2025-04-01 00:00:00"), ("2025.04.01", "2025-04-01 00:00:00"), ("01-04-2025", "2025-01-04 00:00:00"),
    ("1 Apr 2025 09:30", "2025-04-01 09:30:00"), ("2025-04-01T10:00:00+02:00", "2025-04-01 08:00:00"),
    ("12345678901", None), ("PM", None), ("20251301", None),
])
def test_more_layouts(spark, text, want):
    row = spark.createDataFrame([(text,)], "t string").select(
        ts.text_to_utc(F.col("t")).cast("string").alias("d")).first()
    assert row.d == want
