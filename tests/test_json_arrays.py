"""JSON arrays read by many tasks against one parse of the whole file."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voicetide.sources import json_arrays as ja
from voicetide.sources import raw_json as rj

PIECES = ['}', '{', '[', ']', '"', '\\', ',', ':', "},{", '"},{"', "é", "x y", "\n", '\\"', "1"]


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def item(draw: random.Random, i: int) -> dict:
    text = "".join(draw.choices(PIECES, k=draw.randrange(40)))
    nested = [{"a": text}, [], {}, [{"b": [i, {"c": "]}"}]}]]
    return {"id": str(i), "text": text, "tags": nested[: draw.randrange(5)], "likeCount": i}


def land(folder, items, name="a.json", indent=None):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(items, ensure_ascii=False, indent=indent), encoding="utf-8")
    return str(folder)


def parsed(spark, path):
    return [json.loads(r.record) for r in ja.array_records(spark, path).collect()]


def by_id(items):
    return sorted(items, key=lambda x: int(x["id"]))


@pytest.mark.parametrize("indent", [None, 1])
def test_one_array_by_several_tasks(spark, tmp_path, small_blocks, indent):
    draw = random.Random(7)
    items = [item(draw, i) for i in range(10_000)]
    path = land(tmp_path / "in", items, indent=indent)
    small_blocks(150_000)
    found = ja.array_records(spark, path)
    assert spark.read.text(path, lineSep="}").rdd.getNumPartitions() > 10
    assert by_id(json.loads(r.record) for r in found.collect()) == items


def test_records_longer_than_a_block(spark, tmp_path, small_blocks):
    draw = random.Random(3)
    items = [item(draw, i) for i in range(60)]
    for i in (0, 7, 8, 30, 59):
        items[i]["text"] = '},{"id": "[' * 4_000 + str(i)
        items[i]["tags"] = [{"n": k} for k in range(2_000)]
    path = land(tmp_path / "in", items)
    for size in (23_001,):
        small_blocks(size)
        assert by_id(parsed(spark, path)) == items


def test_several_files_and_empty_ones(spark, tmp_path, small_blocks):
    small_blocks(1_500)
    items = [{"id": str(i), "text": "}" * i} for i in range(90)]
    land(tmp_path / "in", items[:50], "a.json")
    land(tmp_path / "in", items[50:], "b.json")
    land(tmp_path / "in", [], "c.json")
    path = land(tmp_path / "in", [{}], "d.json")
    (tmp_path / "in" / "e.json").write_text("")
    (tmp_path / "in" / "f.json").write_text(" [\n ] \n")
    found = parsed(spark, path)
    assert found.count({}) == 1 and by_id(x for x in found if x) == items


BLOCK = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.dictionaries(BLOCK, st.one_of(BLOCK, st.lists(st.dictionaries(BLOCK, BLOCK)))), max_size=6), st.data())
def test_any_cut(items, data):
    """The scans themselves, whatever pieces make a block."""
    pieces = json.dumps(items).encode().split(b"}")
    cuts = sorted(data.draw(st.sets(st.integers(1, max(1, len(pieces) - 1)), max_size=4)))
    blocks = [b for b in (pieces[a:z] for a, z in zip([0, *cuts], [*cuts, len(pieces)], strict=True)) if b]
    inside = depth = 0
    owner, rows = None, []
    for k, block in enumerate(blocks):
        now = ja.Block("f", k, inside, depth, owner, k == len(blocks) - 1)
        low = inside == 0 and depth <= 1 or k == 0
        for piece in block:
            rows.extend(now.feed(piece))
            flips, *change = ja.change(piece)
            depth += change[inside]
            inside ^= flips
            low = low or (not inside and depth <= 1)
        rows.extend(now.end())
        owner = k if low else owner
    whole = [r[3] for r in rows if r[2] is None]
    parts = {}
    for _, _, key, text in rows:
        if key is not None:
            parts[key] = parts.get(key, b"") + text
    found = [json.loads(t) for t in [*whole, *parts.values()]]
    assert sorted(map(json.dumps, found)) == sorted(map(json.dumps, items))


BROKEN = {
    "not an object": ('[{"id": "1"}, 5, {"id": "2"}]', 2),
    "bad field": ('[{"id": "1"}, {"id": oops}, {"id": "2"}]', 2),
    "no end": ('[{"id": "1"}, {"id": "2"}', 1),
    "cut in a number": ('[{"id": "1"}, {"id": "2", "likeCount": 12', 1),
    "cut in a record": ('[{"id": "1"}, {"id": "2', 1),
    "cut after a comma": ('[{"id": "1"}, {"id": "2"},', 2),
    "no comma": ('[{"id": "1"} {"id": "2"}]', 2),
    "more after it": ('[{"id": "1"}, {"id": "2"}] {"id": "3"}', 2),
    "no array": ('"id"', 0),
}


@pytest.mark.parametrize("name", BROKEN)
def test_broken_arrays_fail_or_are_set_aside(spark, tmp_path, name):
    text, good = BROKEN[name]
    (tmp_path / "acme_twitter.json").write_text(text)
    with pytest.raises(Exception):
        rj.read_raw(spark, str(tmp_path), ["acme"], "twitter").collect()
    held = str(tmp_path / "held")
    found = rj.read_raw(spark, str(tmp_path), ["acme"], "twitter", quarantine=held)
    ids = [r.i for r in found.select(F.try_variant_get(F.col("id"), "$", "string").alias("i")).collect()]
    assert len(ids) == good and "1" in [*ids, "1" if not good else ""]
    aside = spark.read.json(f"{held}/acme_twitter").collect()
    assert aside and all(r.file.endswith("acme_twitter.json") for r in aside)


def test_equal_to_the_whole_file_reader(spark, tmp_path, small_blocks):
    draw = random.Random(11)
    items = [item(draw, i) for i in range(500)]
    land(tmp_path / "in", items)
    (tmp_path / "acme_twitter.json").write_text(json.dumps(items))
    small_blocks(9_000)
    found = rj.read_raw(spark, str(tmp_path), ["acme"], "twitter")
    schema = found.drop("brand").schema
    whole = spark.read.schema(schema).option("multiLine", True).json(str(tmp_path / "acme_twitter.json"))

    def shown(rows):
        return sorted(json.dumps(r.asDict(recursive=True), default=str, sort_keys=True) for r in rows.select(F.to_json(F.struct("*")).alias("j")).collect())

    assert shown(found.drop("brand")) == shown(whole)
