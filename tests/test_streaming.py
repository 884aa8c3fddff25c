"""Stateful ingest against the batch operators, with late, repeated and undated items and a failure."""

import json

import pytest

from voicetide.config import Calendar
from voicetide.operators.classify import classify_posts
from voicetide.operators.cube import feedback_cube
from voicetide.operators.dedup import dedup_prefix
from voicetide.operators.metrics import monthly_totals
from voicetide.sources import raw_json as rj
from voicetide.streaming import landed as ld
from checks import adapters as ad

CALENDAR = Calendar.of(2025, (4, 5, 6))
TX = ad.TEXT_TAXONOMY


def item(id_, day, text=None):
    date = None if day is None else f"2025-{day}T10:00:00"
    return {"id": id_, "text": text or f"license text number {id_} goes here", "createdAt": date, "likeCount": 2}


#: Three landings: the second repeats posts of the first and holds a late one, the third repeats both.
LANDINGS = [
    {"acme": [item("1", "04-02"), item("2", "04-20"), item("3", None)], "glo bex": [item("1", "04-03")]},
    {"acme": [item("1b", "04-21", "license text number 1 goes here"), item("4", "04-05"), item("5", "05-01")]},
    {"acme": [item("6", "05-02"), item("2b", "05-03", "license text number 2 goes here"), item("7", "06-09"), item("8", None)],
     "glo bex": [item("1c", "04-30", "license text number 1 goes here"), item("9", "05-05")]},
]


def land(root, number, landing):
    for brand, items in landing.items():
        folder = root / f"{brand}_twitter.json"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{number}.json").write_text("".join(json.dumps(i) + "\n" for i in items))


def enrich(posts):
    return classify_posts(posts, TX)


def ingest(spark, root, where):
    items = ld.landed_brands(spark, str(root), "twitter")
    query = ld.start_ingest(
        items, "twitter", f"{where}/posts", f"{where}/state", enrich, delay="40 days", cube=f"{where}/cube", calendar=CALENDAR
    )
    query.awaitTermination()


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def batch_posts(spark, root):
    items = rj.read_raw(spark, str(root), ["acme", "glo bex"], "twitter", json_arrays=False)
    return enrich(dedup_prefix(ld.landed_posts(items, "twitter")))


CUBE = [*ld.CUBE_KEYS, "n", "complaints", "negatives", "engagement_sum"]


@pytest.mark.parametrize("fails_at", [None, 1])
def test_batches_equal_the_batch_result(spark, tmp_path, monkeypatch, fails_at):
    root, where = tmp_path / "landed", tmp_path / "out"
    whole = ld.feedback_cube
    for number, landing in enumerate(LANDINGS):
        land(root, number, landing)
        if number == fails_at:
            # killed between the posts and the cube
            def fail(*_):
                raise RuntimeError("executor lost")

            monkeypatch.setattr(ld, "feedback_cube", fail)
            with pytest.raises(Exception, match="executor lost"):
                ingest(spark, root, where)
            monkeypatch.setattr(ld, "feedback_cube", whole)
        ingest(spark, root, where)
    ingest(spark, root, where)  # nothing new: nothing changes
    want = batch_posts(spark, root)
    got = ld.read_ingested(spark, f"{where}/posts")
    columns = ["id", "brand", "text", "date", "month", "bucket", "likes"]
    assert rows(got, *columns) == rows(want, *columns)
    assert {r.id for r in got.collect()} == {"1", "2", "3", "4", "5", "6", "7", "8", "9"}
    cube = ld.read_cube(spark, f"{where}/cube")
    assert rows(cube, *CUBE) == rows(feedback_cube(want, ld.CUBE_KEYS, CALENDAR), *CUBE)
    by_month = ["brand", "month", "total"]
    assert rows(monthly_totals(cube, ("acme", "glo bex"), CALENDAR), *by_month) == rows(
        monthly_totals(feedback_cube(want, ld.CUBE_KEYS, CALENDAR), ("acme", "glo bex"), CALENDAR), *by_month
    )


def test_a_batch_run_twice_counts_once(spark, tmp_path):
    root = tmp_path / "landed"
    land(root, 0, LANDINGS[0])
    posts = batch_posts(spark, root)
    for _ in range(2):
        ld.write_batch(posts, 0, f"{tmp_path}/posts", f"{tmp_path}/cube", CALENDAR)
    assert ld.read_ingested(spark, f"{tmp_path}/posts").count() == posts.count() == 4
    assert sum(r.n for r in ld.read_cube(spark, f"{tmp_path}/cube").collect()) == 4


def test_a_batch_has_few_files(spark, tmp_path):
    root = tmp_path / "landed"
    land(root, 0, LANDINGS[2])
    ld.write_batch(batch_posts(spark, root).repartition(12), 0, f"{tmp_path}/posts")
    files = list((tmp_path / "posts").rglob("*.parquet"))
    assert len(files) == len({f.parent for f in files})


def test_a_batch_of_a_stream_with_state_has_few_files(spark, tmp_path):
    # one landed file a post: planned without AQE, a file per task, brand and month would result
    root = tmp_path / "landed"
    posts = [item(str(i), f"04-{1 + i % 28:02d}", f"license text number {i} goes here") for i in range(40)]
    land(root, 0, {"acme": posts})
    before = spark.conf.get("spark.sql.adaptive.enabled")
    ingest(spark, root, tmp_path)
    assert ld.read_ingested(spark, f"{tmp_path}/posts").count() == 40
    files = list((tmp_path / "posts").rglob("*.parquet"))
    assert len(files) == len({f.parent for f in files}) == 1
    assert spark.conf.get("spark.sql.adaptive.enabled") == before
