import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voicetide.llm import queries
from voicetide.llm import spelling as sp


def near(words):
    """Word -> all words at one edit, by deletions and masked letters."""
    without, masked = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            without[w[:i] + w[i + 1 :]].add(w)
            masked[i, w[:i] + "\0" + w[i + 1 :]].add(w)
    found = {w: set() for w in words}
    for short, longer in without.items():
        if short in found:
            found[short] |= longer
            for w in longer:
                found[w].add(short)
    for group in masked.values():
        for w in group:
            found[w] |= group - {w}
    return found


def brute(counts, ratio=10):
    found, forms = near(counts), {}
    for w, n in counts.items():
        best = min(found[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best and counts[best] >= ratio * n else None

    def root(w):
        while forms[w]:
            w = forms[w]
        return w

    return {w: (forms[w], root(w), n, len(found[w]), counts.get(forms[w])) for w, n in counts.items()}


def counted(docs, planted=31):
    out = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if planted and h % planted == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def rows_of(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


def table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def test_query_against_brute_force(spark, small, documents):
    want = brute(counted([(r.doc_id, r.text) for r in documents.collect()]))
    assert want and rows_of(queries.op12_spelling(spark, small)) == want


def compared(counts, step):
    """What the blocks of a vocabulary find, without Spark."""
    out = defaultdict(lambda: [0, []])
    buckets = defaultdict(list)
    for w in counts:
        for m in (len(w), len(w) - 1):
            if m:
                buckets[m, False, w[: m // 2]].append(w)
                buckets[m, True, w[len(w) - (m - m // 2) :]].append(w)
    for (m, back, _), words in buckets.items():
        found, n = sp.np.array(words), sp.np.array([counts[w] for w in words])
        every = sp.np.ones(len(words), bool)
        for word, k, best_n, best in sp.compare(m, back, found, n, every, every):
            out[word][0] += k
            out[word][1].append((-best_n, best))
    return {w: (k, min(best)[1]) for w, (k, best) in out.items()}


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text("aabé", min_size=1, max_size=9), st.integers(1, 50), max_size=120), st.sampled_from([64, 1024]))
def test_pairs_are_found_once(counts, step):
    """Few letters: many pairs, and edits that can be read at several positions."""
    old, sp.BLOCK = sp.BLOCK, step
    try:
        want = {w: (len(o), min(o, key=lambda x: (-counts[x], x))) for w, o in near(counts).items() if o}
        assert compared(counts, step) == want
    finally:
        sp.BLOCK = old


@pytest.mark.parametrize("tile, groups", [(16, 1_000_000), (sp.TILE, sp.GROUPS)])
def test_a_hot_bucket(spark, tile, groups):
    """A third of all words share their first and a third their last letters."""
    counts = {f"samebegin{chr(97 + i % 26)}{chr(97 + i // 26)}": i % 50 + 2 for i in range(300)}
    counts |= {f"{chr(97 + i % 26)}{chr(97 + i // 26)}sameending": i % 50 + 2 for i in range(300)}
    counts |= {f"single{chr(97 + i % 26) * 2}{chr(97 + i // 26) * 3}": 2 for i in range(300)}
    got = {r.word: (r.n_near, r.best) for r in sp.near_words(table(spark, counts), tile, groups).collect()}
    want = {w: (len(o), min(o, key=lambda x: (-counts[x], x))) for w, o in near(counts).items() if o}
    assert got == want


def test_roots_follow_all_forms(spark):
    counts = {"abcdefgh": 100_000, "abcdefgi": 5_000, "abcdefji": 200, "abcdekji": 10, "abcxekji": 1, "zzzzzzzzz": 3}
    want = brute(counts)
    assert want["abcxekji"][1] == "abcdefgh"
    assert rows_of(sp.variants(table(spark, counts))) == want


def test_cases(spark, edge, nothing):
    docs = edge.select("doc_id", "text", "score")
    want = brute(counted([(r.doc_id, r.text) for r in docs.collect()], 0))
    assert rows_of(sp.variants(sp.words(docs))) == want
    assert rows_of(sp.variants(sp.words(nothing))) == {}
    mixed = spark.createDataFrame(
        [(1, "ÀÉÎabcdef ÀÉÎABCDEF"), (2, "àéîabcdef àéîabcdef"), (None, "a×bcdefg÷hijklmn " * 2), (3, "abcdefg1hijklmn_opqrstu")],
        "doc_id long, text string",
    )
    want = counted([(r.doc_id, r.text) for r in mixed.collect()], 0)
    assert {r.word: r.n for r in sp.words(mixed).collect()} == want and "ÀÉÎabcdef" in want
    long = {"x" * 40_000: 30, "x" * 40_001: 2, "x" * 39_999 + "y": 3}
    assert rows_of(sp.variants(table(spark, long))) == brute(long)
