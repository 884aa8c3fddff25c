import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from voicetide.llm import lattice, lm, vocab

PATH = vocab.default_pieces()


def brute(word, log_p):
    """Natural log of the sum over all segmentations, by recursion on the first piece."""
    pieces = vocab.pieces(PATH)
    text = lattice._marked(word)

    def rest(at):
        if at == len(text):
            return 1.0
        total = 0.0
        for end in range(at + 1, len(text) + 1):
            part, last = text[at:end], end == len(text)
            piece = pieces.ids.get(part)
            if piece is not None:
                ids = [piece]
            elif len(part) == 1:
                ids = pieces.fallback(part)
            else:
                continue
            ids = [*ids[:-1], ids[-1] + last * pieces.size]
            total += math.exp(sum(log_p[i] for i in ids)) * rest(end)
        return total

    return math.log(rest(0))


@pytest.fixture(scope="module")
def log_p():
    return lm.normalised(np.tile(lm.initial(PATH), 2) / 2, PATH)


def likelihood(words, log_p):
    return lattice.log_likelihood(words, [log_p], PATH)[:, 0]


WORDS = [b"a", b"the", b"nation,", "éß!".encode(), "\U0001f600x".encode(), b"42", "a▁b".encode(), b"x" * 12]


def test_forward_sums_all_segmentations(log_p):
    found = likelihood(WORDS, log_p)
    assert np.allclose(found, [brute(w, log_p) for w in WORDS], rtol=1e-9)


def test_long_words_take_the_same_recursion(log_p, monkeypatch):
    words = [b"internationalisations" * k for k in (1, 2, 3)] + WORDS
    weight = np.arange(1.0, len(words) + 1)
    arrays = likelihood(words, log_p), lattice.expected_counts(words, weight, log_p, PATH)
    monkeypatch.setattr(lattice, "ARRAY_LENGTH", 0)
    assert np.allclose(arrays[0], likelihood(words, log_p))
    assert np.allclose(arrays[1], lattice.expected_counts(words, weight, log_p, PATH))


def test_expected_counts_are_the_gradient(log_p):
    step, words = 1e-5, WORDS[:4]
    counts = lattice.expected_counts(words, np.ones(4), log_p, PATH)
    for i in np.argsort(-counts)[:6]:
        moved = log_p.copy()
        moved[i] += step
        change = likelihood(words, moved).sum() - likelihood(words, log_p).sum()
        assert abs(change / step - counts[i]) < 1e-3


def test_word_probabilities_sum_to_at_most_one(log_p):
    letters = [bytes([c]) for c in range(33, 127)]
    words = letters + [a + b for a in letters for b in letters]
    assert 0.05 < np.exp(likelihood(words, log_p)).sum() < 1


def expected_base(texts):
    """(score, n_tokens, n_known) per row, and the training tokens, counted plainly."""
    words = [(t or "").encode().lower().split() + [b"\nend"] for _, t in texts]
    training = Counter()
    for (i, _), w in zip(texts, words, strict=True):
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            training.update(w)
    n, v = training.total(), len(training)
    return n, [
        (sum(math.log10((training[x] + 1) / (n + v + 1)) for x in w), len(w), sum(training[x] > 0 for x in w))
        for w in words
    ]


@pytest.mark.parametrize("head", [0, 40, 10**6])
def test_base_score_against_plain_counts(documents, head):
    docs = documents.limit(60)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    n, want = expected_base(texts)
    found = {r.doc_id: r for r in lm.score(docs, head_words=head).collect()}
    assert len(found) == len(texts)
    for (i, _), (base, tokens, known) in zip(texts, want, strict=True):
        r = found[i]
        assert r.train_tokens == n and r.n_tokens == tokens and r.n_known == known
        assert abs(r.base_score - base) < 1e-8 * abs(base)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)


def test_head_and_partitioning_do_not_change_the_score(documents):
    docs = documents.limit(40)
    runs = [lm.score(d, head_words=h).orderBy("doc_id").collect()
            for d, h in ((docs, 30), (docs.repartition(5), 10**6))]
    assert all(abs(a.score - b.score) < 1e-6 * abs(a.score) for a, b in zip(*runs, strict=True))


def test_held_out_rows_teach_nothing(documents):
    docs = documents.limit(60)
    out = lm.held_out()
    other = docs.withColumn("text", F.when(out, F.concat(F.lit("zyx qwv "), "text")).otherwise(F.col("text")))
    a, b = (lm.score(d).filter("NOT held_out").orderBy("doc_id").collect() for d in (docs, other))
    assert all(abs(x.score - y.score) < 1e-7 * abs(x.score) for x, y in zip(a, b, strict=True))


def test_it_beats_the_base_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = lm.score(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_cases(edge, nothing):
    texts = [(r.doc_id, r.text) for r in edge.collect()]
    n, want = expected_base(texts)
    found = lm.score(edge).collect()
    assert sorted((round(r.base_score, 6), r.n_tokens, r.n_known) for r in found) == sorted(
        (round(b, 6), t, k) for b, t, k in want
    )
    assert all(math.isfinite(r.score) and r.train_tokens == n for r in found)
    assert lm.score(nothing).count() == 0
    only_held_out = edge.filter(lm.held_out())
    assert all(r.n_known == 0 and math.isfinite(r.score) for r in lm.score(only_held_out).collect())
