import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from voicetide.llm import packing as pk

ODD = ["", "İSTANBUL ΣΑΣ", "a<|endoftext|>B <|EndOfText|> <|startoftext|>,.", "x\x1cy\x85z　q", "don't I'LL,",
       "é. É, ́,", "KK,", "ﬁ, ſ.", "o'.", "a.,", "'s,", "12, ½.", " .", "日本,語.", "A" * 3000, "ª, º."]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(pk.default_tokenizer())


def test_ids_are_the_tokenizers(documents, tokenizer):
    texts = ODD + [r.text for r in documents.collect()]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert list(pk.WordIds(pk.default_tokenizer()).encode(texts)) == want


def test_a_small_cache_gives_the_same(documents, tokenizer, monkeypatch):
    monkeypatch.setattr(pk, "CACHE_WORDS", 50)
    texts = [r.text for r in documents.limit(40).collect()]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert list(pk.WordIds(pk.default_tokenizer()).encode(texts)) == want


@pytest.mark.parametrize("n", [1, 2, 3, 2047, 2048, 2049, 4096, 10_000])
def test_lengths(n):
    found = pk.lengths(n)
    assert sum(found) == n and all(x & (x - 1) == 0 and x <= 2048 for x in found)
    assert len(found) == n // 2048 + bin(n % 2048).count("1") and found == sorted(found, reverse=True)


def check(docs, pieces, tokenizer):
    """Every id of every document in exactly one piece, sequences whole and of one document."""
    by_doc = {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert len({r.sequence_id for r in pieces}) == len(pieces)
    assert all(r.offset == 0 and r.length == 1 << r.bucket and r.length <= 2048 for r in pieces)
    for doc_id, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        mine = sorted(by_doc[doc_id], key=lambda r: r.start)
        assert [r.start for r in mine] == [0, *np.cumsum([r.length for r in mine])[:-1]]
        assert {r.doc_tokens for r in mine} == {len(ids)} and sum(r.length for r in mine) == len(ids)
        for r in mine:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_query_against_brute_force(documents, tokenizer):
    rows = pk.digest(pk.pieces(documents)).collect()
    check([(r.doc_id, r.text) for r in documents.collect()], rows, tokenizer)


def test_cases(edge, nothing, tokenizer):
    named = edge.withColumn("doc_id", pk.F.monotonically_increasing_id())
    check([(r.doc_id, r.text) for r in named.collect()], pk.digest(pk.pieces(named)).collect(), tokenizer)
    rows = pk.digest(pk.pieces(edge)).collect()
    assert sum(r.length == 1 == r.doc_tokens for r in rows) == sum(not (r.text or "").strip() for r in edge.collect())
    assert pk.pieces(nothing).count() == 0
    with pytest.raises(ValueError):
        pk.pieces(edge, most=1000)


def test_buckets_hold_equal_lengths(spark, documents, tmp_path):
    path = str(tmp_path / "packed")
    pk.write_buckets(pk.pieces(documents), path)
    back = spark.read.parquet(path)
    sizes = back.groupBy("bucket").agg(pk.F.collect_set(pk.F.length("ids")).alias("s")).collect()
    assert all(r.s == [4 << r.bucket] for r in sizes)


def test_caches_end_with_their_task(spark):
    """Workers serve many tasks; what one keeps must not reach the next."""
    rows = spark.range(4).select(pk.F.lit("x").alias("text")).repartition(1)

    def make_with(value):
        def make(texts):
            return None, [[pk.base.kept(("probe",), lambda: value) for _ in texts]]

        return {r.v for r in pk.base.add_columns(rows, make, "v long", ["text"], []).collect()}

    assert make_with(1) == {1} and make_with(2) == {2}
