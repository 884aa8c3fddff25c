"""Dedup, filters, unions, joins and ranking."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from voicetide.config import FocusRule
from voicetide.operators import dedup as dd
from voicetide.operators import filters as fl
from voicetide.operators import joins as jn
from voicetide.operators import topn as tn
from voicetide.operators import unions as un

POSTS = "id string, brand string, platform string, text string, date timestamp_ntz"


def test_dedup_keeps_the_earliest_and_puts_null_dates_last(spark):
    rows = spark.createDataFrame([
        ("1", "x", "p", "same", None),
        ("2", "x", "p", "same", datetime(2025, 5, 2)),
        ("3", "x", "p", "same", datetime(2025, 5, 1)),
        ("4", "x", "p", "same", datetime(2025, 5, 1)),
        ("5", "x", "q", "same", None),
        ("6", "y", "p", "same", None),
        ("7", "x", "p", "s" * 200 + "1", None),
        ("8", "x", "p", "s" * 200 + "2", None),
    ], POSTS)
    kept = dd.dedup_prefix(rows)
    assert sorted(r.id for r in kept.collect()) == ["3", "5", "6", "7"]
    assert kept.columns == rows.columns
    assert sorted(dd.dedup_prefix(kept).collect()) == sorted(kept.collect())


def test_dedup_of_one_hot_key_against_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        text = "hot" if rng.random() < 0.4 else f"t{rng.randrange(900)}"
        date = None if rng.random() < 0.1 else datetime(2025, 5, 1 + rng.randrange(20))
        rows.append((f"{i:05d}", rng.choice("xy"), "p", text, date))
    want = {}
    for r in sorted(rows, key=lambda r: (r[4] is None, r[4] or datetime.min, r[0])):
        want.setdefault((r[1], r[2], r[3][:200]), r[0])
    for parts in (1, 9):
        frame = spark.createDataFrame(rows, POSTS).repartition(parts)
        assert {r.id for r in dd.dedup_prefix(frame).collect()} == set(want.values())


def test_key_chain(spark):
    rows = spark.createDataFrame([
        ("u1", "a", "r1", 1), ("u1", "b", "r2", 2), ("", "a", "r3", 3), (None, "a", "r4", 4),
        ("", "", "same", 5), (None, "", "same", 6), ("", "", "same", 7),
    ], "url string, id string, body string, n int")
    items = rows.drop("n")
    keyed = rows.withColumn("k", dd.record_key(items))
    kept = dd.keep_first(keyed, [F.col("k")], [F.col("n")])
    # The null url is not in the record text, so rows 5 and 6 differ.
    assert sorted(r.n for r in kept.collect()) == [1, 3, 5, 6]
    assert dd.dedup_key_chain(items, [F.col("body"), F.col("id")]).count() == 4


@pytest.mark.parametrize("salts", [1, 64])
def test_top_n_against_brute_force(spark, salts):
    rng = random.Random(3)
    rows = [
        ("hot" if rng.random() < 0.5 else f"g{rng.randrange(5)}", rng.randrange(50), f"{i:04d}")
        for i in range(2000)
    ]
    frame = spark.createDataFrame(rows, "g string, score bigint, id string").repartition(17)
    got = tn.top_n(frame, ["g"], [F.desc("score"), F.asc("id")], 8, salts=salts).collect()
    want = set()
    for group in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == group), key=lambda r: (-r[1], r[2]))
        want |= {(r[0], r[2], i + 1) for i, r in enumerate(ordered[:8])}
    assert {(r.g, r.id, r.rn) for r in got} == want


@pytest.mark.parametrize("spread_of_scores", [1, 3, 5000])
def test_top_posts_against_brute_force(spark, spread_of_scores):
    rng = random.Random(11)
    rows = [
        ("x" if rng.random() < 0.7 else "y", rng.choice("AB"),
         None if rng.random() < 0.05 else rng.randrange(spread_of_scores), f"{i:04d}")
        for i in range(1500)
    ]
    rows += [("z", "A", 5, "z1"), ("z", "A", None, "z2"), (None, "A", 1, "n1")]
    # Many posts without an id share one part of the floor.
    rows += [("w", "A", i, "") for i in range(40)]
    frame = spark.createDataFrame(rows, "brand string, bucket string, engagement bigint, id string")
    got = tn.top_posts(frame.repartition(5), 8, columns=("id", "engagement")).collect()
    want = []
    for group in {r[:2] for r in rows}:
        mine = [r for r in rows if r[:2] == group]
        mine.sort(key=lambda r: (r[2] is None, -(r[2] or 0), r[3]))
        want += [(*r[:2], r[3], r[2], i + 1) for i, r in enumerate(mine[:8])]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_focus_rule(spark):
    rule = FocusRule("Acme", ("garden", "shop floor"), ("order",))
    rows = spark.createDataFrame([
        ("x", "ACME is late"), ("x", "acme garden"), ("x", "acme garden ORDER"), ("x", "garden order"),
        ("x", "acme shop floor"), ("x", None), ("y", "acme"), ("z", "acme"),
    ], "brand string, text string")
    got = fl.focus_filter(rows, {"x": rule, "y": FocusRule("acme", ("acme",))}).collect()
    assert [r.text for r in got] == ["ACME is late", "acme garden ORDER"]


@pytest.mark.parametrize("computed", [False, True])
def test_window_keeps_null_and_both_ends(spark, computed):
    days = [None, datetime(2025, 3, 31, 23, 59, 59), datetime(2025, 4, 1),
            datetime(2025, 7, 1, 23, 59, 59), datetime(2025, 7, 2)]
    rows = spark.createDataFrame([(d,) for d in days], "date timestamp_ntz")
    kept = fl.date_window(rows, "2025-04-01 00:00:00", "2025-07-01 23:59:59", computed)
    assert [r.date for r in kept.collect()] == [days[0], days[2], days[3]]


def test_empty_selection_does_not_filter(spark):
    rows = spark.createDataFrame([("x", "April"), ("y", "May")], "brand string, month string")
    assert fl.multiselect(rows, brand=[], month=[]).count() == 2
    assert fl.multiselect(rows, brand=["x"], month=[]).count() == 1
    assert fl.multiselect(rows, brand=["x"], month=["May"]).count() == 0


def test_unions(spark):
    a = spark.createDataFrame([("1", "x")], "id string, brand string")
    b = spark.createDataFrame([("y", "1"), ("y", "2")], "brand string, id string")
    c = spark.createDataFrame([("3",)], "id string")
    assert un.union_all([a, b]).filter("id = '1'").count() == 2
    assert {tuple(r) for r in un.union_missing([a, c]).collect()} == {("1", "x"), ("3", None)}
    merged = un.first_non_empty([a, b, c], "id")
    assert {tuple(r) for r in merged.select("id", "brand").collect()} == {
        ("1", "x"), ("2", "y"), ("3", None)}


def test_topics_and_labels_join(spark):
    from voicetide.lexicons import default_taxonomy

    rows = spark.createDataFrame(
        [("1", "A_Cancellation"), ("2", "nope")], "id string, bucket string")
    topics = spark.createDataFrame([("1", "late_bus")], "id string, topic_label string")
    got = jn.attach_topics(rows, topics).orderBy("id").collect()
    assert [r.topic_label for r in got] == ["late_bus", ""]
    dim = default_taxonomy().to_df(spark)
    got = jn.attach_labels(rows, dim).orderBy("id").collect()
    assert [r.bucket_label for r in got] == ["A. Cancellation", None]


def test_seeded_shuffle_ignores_partitions(spark):
    rows = spark.range(200).select(F.col("id").cast("string").alias("id"))
    first, again, other = (
        [r.id for r in tn.seeded_shuffle(rows.repartition(n), seed=s).collect()]
        for n, s in ((1, 42), (7, 42), (3, 43))
    )
    assert first == again != other
    assert sorted(first) == sorted(other)


def test_preview_orders_null_dates_last(spark):
    rows = spark.createDataFrame(
        [("1", None), ("2", datetime(2025, 1, 2)), ("3", datetime(2025, 1, 1))],
        "id string, date timestamp_ntz")
    assert [r.id for r in tn.preview(rows, 2).collect()] == ["3", "2"]
