import random
import re
from collections import Counter

import numpy as np
import pytest

from voicetide.llm import quality as ql

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@pytest.mark.parametrize("text", [
    None, "", " ", "a", "a a", "a a a", "a a a a", "x y z x y z", "é ü\n\né ü\n é ü", "a\x0bb\x0cc\x85d\xa0e",
    "#*$%&|<> #\n#*$%&|<> #", "\n".join(["one two three"] * 4), "a b " * 50 + "c",
])
def test_counts(text):
    words, chars, symbols, dup, _, repeated = ql.text_stats(text)
    assert (words, chars, symbols, dup, repeated) == brute(text)


def test_counts_on_documents(documents):
    for r in documents.limit(80).collect():
        words, chars, symbols, dup, _, repeated = ql.text_stats(r.text)
        assert (words, chars, symbols, dup, repeated) == brute(r.text)


def reference_mcd(x, priors, floor):
    """Concentration steps over sorted distances, without bins."""
    center, cov = np.median(x, 0), None
    spread = ((np.quantile(x, 0.75, 0) - np.quantile(x, 0.25, 0)) / 1.349) ** 2 + floor**2
    inverse = np.diag(1 / spread)
    for _ in range(25):
        gap = x - center
        d = np.einsum("ij,jk,ik->i", gap, inverse, gap)
        h = x[np.argsort(d, kind="stable")[: int(np.ceil(ql.H * len(x)))]]
        center, cov = h.mean(0), ql.CONSISTENCY * np.cov(h.T, bias=True) + np.diag(floor**2)
        inverse = np.linalg.inv(cov)
    return center, inverse


def test_estimates_come_near_exact_steps(spark):
    rng = np.random.default_rng(3)
    good = rng.multivariate_normal([1.6, 0, 0.2, 0.1], np.diag([0.02, 1e-6, 0.05, 0.04]), 1500)
    bad = rng.multivariate_normal([2.2, 3, 0.2, 0.1], np.diag([0.02] * 4), 300)
    x = np.vstack([good, bad])
    rows = [("en", "s", *map(float, v)) for v in x]
    stats = spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"{c} double" for c in ql.NAMES))
    found = ql.estimates(stats).collect()
    assert len(found) == 1
    floor = np.array(list(ql.FEATURES.values()))
    center, inverse = reference_mcd(x, None, floor)
    assert np.allclose(found[0].center, center, atol=0.03)
    gap = x - np.array(found[0].center)
    d = np.einsum("ij,jk,ik->i", gap, np.array(found[0].inverse).reshape(4, 4), gap)
    assert (d[:1500] > ql.CUTOFF).mean() < 0.01 and (d[1500:] > ql.CUTOFF).all()


def documents_of(kind, n):
    draw = random.Random(kind)
    for i in range(n):
        words = [f"{draw.choice('bdfgk')}{draw.choice('aeiou')}{draw.choice('lmnrst')}{i}x{k}"[:6] for k in range(90)]
        if kind == "junk":
            words = [f"{w}***" for w in words]
        yield " ".join(words)


def test_junk_goes_and_the_rest_stays(spark, edge):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(documents_of("good", 120))]
    rows += [(1000 + i, t, "en", "a", 1) for i, t in enumerate(documents_of("junk", 25))]
    rows += [(2000, rows[0][1], None, None, 1), (2001, None, "en", "a", None), (2002, "short", "xx", "b", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r for r in ql.judge(docs).collect()}
    assert len(found) == len(rows)
    assert all(found[i].kept for i in range(120)) and not any(found[1000 + i].kept for i in range(25))
    assert found[2000].kept  # a group of its own
    assert found[2001].base_failed and found[2002].base_failed and not found[2001].kept
    kept = ql.keep_clean(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in found.items() if r.kept)


def test_cases(edge, nothing):
    rows = ql.judge(edge).collect()
    assert len(rows) == edge.count()
    assert all(r.base_failed for r in rows if r.n_words < 50)
    kept = ql.keep_clean(edge)
    assert kept.columns == edge.columns and kept.count() == sum(r.kept for r in rows) > 0
    assert ql.judge(nothing).count() == 0 and ql.keep_clean(nothing).count() == 0
