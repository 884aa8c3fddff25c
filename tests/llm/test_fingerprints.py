import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voicetide.llm import fingerprints as fp
from voicetide.llm import queries
from voicetide.llm.fingerprints import Fingerprint

LINES = st.lists(st.text("ab \U0001f600é", max_size=20), max_size=12)


def followers(rows):
    """The text after each (doc_id, text), missing ids last, ties by the text's hash."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))
    return [(i, t, ordered[(k + 1) % len(ordered)][1]) for k, (i, t) in enumerate(ordered)]


def checked(rows, frame):
    want = []
    for doc_id, text, after in followers(rows):
        q = len(text) // 4
        new = text[: len(text) - q] + after[:q]
        own, changed, following = Fingerprint.of(text), Fingerprint.of(new), Fingerprint.of(after)
        want.append((
            doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), own.text(), changed.text(),
            own.likeness(changed), own.likeness(following),
        ))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    got = [tuple(r) for r in frame.select(*names).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query_against_brute_force(spark, small, documents):
    rows = queries.op13_fingerprints(spark, small)
    checked([(r.doc_id, r.text or "") for r in documents.collect()], rows)
    near = rows.select("n_chars", "near_edited", "near_next").toPandas()
    long = near[near.n_chars > 100]
    assert (long.near_edited > 0.5).mean() > 0.95 and (long.near_next < 0.5).mean() > 0.95


@settings(max_examples=60, deadline=None)
@given(LINES, LINES, st.randoms())
def test_homomorphism(first, second, r):
    whole = Fingerprint().insert(first + second)
    mixed = first + second
    r.shuffle(mixed)
    assert whole == Fingerprint().insert(mixed) == Fingerprint().insert(first).insert(second)
    assert whole.delete(second) == Fingerprint().insert(first) and whole.likeness(whole) == 1.0
    assert Fingerprint.from_text(whole.text()) == whole
    if sorted(first) != sorted(second):
        assert Fingerprint().insert(first).text() != Fingerprint().insert(second).text()


def test_repeated_paragraphs_count():
    assert Fingerprint.of("a\na") != Fingerprint.of("a") != Fingerprint.of("a\n")


def test_pieces_of_a_long_text_change_nothing(monkeypatch):
    text = "".join(random.Random(5).choices("abcde \n", k=5000)) + "x" * 3000
    whole = Fingerprint.of(text)
    monkeypatch.setattr(fp, "PIECE", 64)
    assert Fingerprint.of(text) == whole


def test_likeness_estimates_common_runs():
    draw = random.Random(1)
    lines = [" ".join(draw.choices("alpha beta gamma delta river house tea hill".split(), k=9)) + str(i) for i in range(200)]
    for share in (0.25, 0.5, 0.9):
        kept = int(200 * share)
        other = lines[:kept] + [line[::-1] for line in lines[kept:]]
        assert Fingerprint().insert(lines).likeness(Fingerprint().insert(other)) == pytest.approx(share, abs=0.2)


@pytest.mark.parametrize("range_rows", [1, 3, 1000])
def test_cases_over_ranges(spark, edge, range_rows):
    rows = [(r.doc_id, r.text or "") for r in edge.select("doc_id", "text").collect()]
    got = [tuple(r) for r in fp.followed(edge, range_rows).collect()]
    assert sorted(got, key=repr) == sorted(followers(rows), key=repr)


def test_cases(spark, edge, nothing):
    checked([(r.doc_id, r.text or "") for r in edge.select("doc_id", "text").collect()], fp.fingerprint(edge))
    assert fp.fingerprint(nothing).collect() == []
    one = nothing.sparkSession.createDataFrame([(4, "alone\nhere")], "doc_id long, text string")
    checked([(4, "alone\nhere")], fp.fingerprint(one))


def test_many_ranges_and_a_hot_id(spark):
    rows = [(i if i % 3 else 7, f"text {i} " * (i % 5)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(7)
    got = [tuple(r) for r in fp.followed(docs, 10).collect()]
    assert sorted(got, key=repr) == sorted(followers(rows), key=repr)
    named = fp.followed(docs.withColumn("doc_id", F.format_string("%05d", "doc_id")), 10)
    assert sorted(r["next"] for r in named.collect()) == sorted(r[1] for r in rows)


def test_digest_is_narrow():
    assert np.frombuffer(Fingerprint.of("x").wide.tobytes(), "u1").size == 8 * fp.WIDE
