"""Frequent labels, deduplication across batches, whole sources, documents by path."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from voicetide.operators import dedup as dd
from voicetide.operators import frequent as fr
from voicetide.sources import commits as cm
from voicetide.sources import document as doc
from voicetide.sources import key_index as ki
from voicetide.sources import raw_json as rj


def best(labels, k):
    return sorted(Counter(x for x in labels if x is not None).items(), key=lambda p: (-p[1], p[0]))[:k]


SKEWED = [f"t{min(int(random.Random(i).paretovariate(0.7)), 5000)}" for i in range(4000)] + [None] * 9
FLAT = [f"u{i % 1500:04d}" for i in range(3000)]


@pytest.mark.parametrize("labels", [SKEWED, FLAT, ["a"], ["", "", "b"], [None], []])
@pytest.mark.parametrize("tracked", [16, 1000])
def test_top_labels(spark, labels, tracked):
    rows = spark.createDataFrame([(x,) for x in labels], "label string").repartition(5)
    got = [tuple(r) for r in fr.top_labels(rows, "label", 4, tracked).collect()]
    assert got == best(labels, 4)


def test_the_bound_holds_and_skewed_labels_need_no_second_pass(spark):
    rows = spark.createDataFrame([(x,) for x in SKEWED], "label string").repartition(5)
    found = fr.candidates(rows, "label", 80, 1000)
    true = Counter(x for x in SKEWED if x is not None)
    assert all(n <= found.bound for x, n in true.items() if x not in found.labels)
    assert fr.settled([true[x] for x in found.labels], 4, found.bound)
    few = fr.candidates(spark.createDataFrame([(x,) for x in FLAT], "label string"), "label", 80, 100)
    assert not fr.settled([2] * 80, 4, few.bound)


def posts(n=400, seed=3):
    rng = random.Random(seed)
    texts = [None, "", "x" * 250, "x" * 250 + "tail"] + [f"text {i}" for i in range(90)]
    return [(i, rng.choice("ab"), rng.choice(texts)) for i in range(n)]


KEYS = ["brand", "text"]


def keyed():
    return [F.col("brand"), F.substring("text", 1, 200)]


def test_batches_equal_one(spark, tmp_path):
    rows = posts()
    frame = spark.createDataFrame(rows, "id long, brand string, text string")
    want = sorted(r.id for r in dd.keep_first(frame, keyed(), [F.col("id")]).collect())
    path = str(tmp_path / "index")
    cuts = [(0, 150), (150, 150), (150, 260), (260, 400)]  # the second batch is empty
    got = []
    for batch, (a, b) in enumerate(cuts):
        some = frame.filter(F.col("id").between(a, b - 1))
        got += [r.id for r in ki.keep_new(some, keyed(), [F.col("id")], path, batch, words=64).collect()]
    assert sorted(got) == want
    # a batch run again gives what it gave, although its own keys are stored now
    some = frame.filter(F.col("id").between(150, 259))
    again = ki.keep_new(some, keyed(), [F.col("id")], path, 2, words=64)
    assert {r.id for r in again.collect()} == {i for i in want if 150 <= i < 260}
    assert again.columns == frame.columns


def test_a_wide_filter_lets_few_new_keys_through(spark, tmp_path):
    path = str(tmp_path / "index")
    old = spark.range(2000).withColumn("k", F.concat(F.lit("old"), "id"))
    ki.keep_new(old, [F.col("k")], [F.col("id")], path, 1, words=1024)
    asked = spark.range(3000).select(ki.digest([F.concat(F.lit("new"), "id")]).alias("digest"))
    assert ki.perhaps_known(asked, path, 2, words=1024).count() < 150
    assert ki.known(asked, path, 2, words=1024).count() == 0
    same = old.select(ki.digest([F.col("k")]).alias("digest"))
    assert ki.perhaps_known(same, path, 2, words=1024).count() == 2000
    assert ki.known(same, path, 2, words=1024).count() == 2000
    assert ki.known(same, path, 1, words=1024).count() == 0  # a batch does not see itself


def test_old_posts_are_not_read(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, text string")
    old.write.parquet(str(tmp_path / "posts-old"))
    path = str(tmp_path / "index")
    ki.keep_new(spark.read.parquet(str(tmp_path / "posts-old")), [F.col("text")], [F.col("id")], path, 0)
    asked = spark.createDataFrame([(3, "b"), (4, None)], "id long, text string")
    known = ki.known(asked.select(ki.digest([F.col("text")]).alias("digest")), path, 1)
    assert "posts-old" not in str(known.inputFiles())
    assert {r.id for r in ki.keep_new(asked, [F.col("text")], [F.col("id")], path, 1).collect()} == {4}


def test_whole_sources(spark, tmp_path):
    real, made = str(tmp_path / "real"), str(tmp_path / "made")
    items = spark.createDataFrame([("1", "hello"), ("2", "x")], "id string, text string")
    for brand in ("a", "b"):
        rj.write_raw(items.withColumn("id", F.concat(F.lit("made"), "id")), rj.raw_path(made, brand, "twitter"))

    def found(brands=("a", "b")):
        rows = cm.posts_of(spark, real, made, "twitter", brands).collect()
        return {(r.data_source, r.brand, r.id) for r in rows}

    substitute = {("synthetic", b, f"made{i}") for b in "ab" for i in (1, 2)}
    assert found() == substitute  # absent
    rj.write_raw(items, rj.raw_path(real, "a", "twitter"))
    rj.write_raw(items, rj.raw_path(real, "b", "twitter"))
    assert found() == substitute  # landed without a marker
    cm.land_source({"a": items, "b": items.limit(0)}, real, "twitter")
    assert found() == {("real", "a", "1"), ("real", "a", "2")}
    assert found(("a", "b", "c"))  == substitute  # a brand that never landed
    cm.land_source({"a": items.limit(0), "b": items.limit(0)}, real, "twitter")
    assert found() == substitute  # whole, but nothing in it
    cm.land_source({"a": items, "b": items}, real, "twitter")
    assert len(found()) == 4
    cm.withdraw(spark, real, "twitter")
    assert found() == substitute


def paths_of(value, path=""):
    """(path, number, text) of every leaf, by recursion."""
    if isinstance(value, dict) and value:
        return [x for k, v in value.items() for x in paths_of(v, f"{path}/{k.replace('~', '~0').replace('/', '~1')}")]
    if isinstance(value, list) and value:
        return [x for i, v in enumerate(value) for x in paths_of(v, f"{path}/{i}")]
    if isinstance(value, (dict, list)):
        return [(path, None, json.dumps(value))]
    if isinstance(value, bool):
        return [(path, None, str(value).lower())]
    return [(path, value, None)] if isinstance(value, (int, float)) else [(path, None, value)]


def test_document_paths(spark, tmp_path):
    document = {
        "kpis": {"a": {"total": 3, "share": 12.5, "big": 1e300, "none": None, "flag": True}, "b": {}},
        "lists": {"a/b~c": [[], {}, "", "12", "[]", [1, [2, {"x": None}]]]}, "plain": 7, "text": "é", "void": None,
    }
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "part-0.json").write_text(json.dumps(document))
    got = {(r.section, r.path, r.number, r.text) for r in doc.document_paths(spark, str(tmp_path / "d")).collect()}
    want = {(s, p, n, t) for s, v in document.items() for p, n, t in paths_of(v)}
    assert got == want


def test_a_document_nested_too_deep_fails(spark, tmp_path):
    value = 1
    for _ in range(doc.DEPTH + 1):
        value = {"x": value}
    (tmp_path / "part-0.json").write_text(json.dumps(value))
    with pytest.raises(Exception, match="nested too deep"):
        doc.document_paths(spark, str(tmp_path)).collect()


def test_a_batch_is_written_once(spark, tmp_path, monkeypatch):
    """Old keys are looked up by digest alone; without an index there is nothing to look up."""
    stored = []
    real = ki.materialise
    monkeypatch.setattr(ki, "materialise", lambda rows, name, *more: stored.append(name) or real(rows, name, *more))
    posts = spark.range(400).select("id", F.concat(F.lit("text "), (F.col("id") % 90).cast("string")).alias("text"))
    path = str(tmp_path / "index")
    first = ki.keep_new(posts.filter("id < 50"), [F.col("text")], [F.col("id")], path, 0)
    second = ki.keep_new(posts.filter("id >= 50"), [F.col("text")], [F.col("id")], path, 1)
    assert sorted(r.id for r in first.collect()) == list(range(50))
    assert sorted(r.id for r in second.collect()) == list(range(50, 90))
    assert stored == ["batch-new", "batch-new"]


def test_landed_items_are_compressed(spark, tmp_path):
    items = spark.range(400).select(F.col("id").cast("string"), F.repeat(F.lit("some text "), 20).alias("text"))
    path = rj.raw_path(str(tmp_path), "a", "twitter")
    rj.write_raw(items, path)
    assert sum(f.stat().st_size for f in (tmp_path / "a_twitter.json").glob("part-*")) < 400 * 200 / 3
    assert rj.read_raw(spark, str(tmp_path), ["a"], "twitter", json_arrays=False).filter("length(text) = 200").count() == 400
