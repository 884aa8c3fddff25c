"""Spelling variants: words at one edit, by a bit-sliced index of letters at positions.

*Words.*  Runs of letters are counted per task, then over the corpus.

*Buckets.*  One edit leaves the first half or the other half of a word as it is.
For a pair whose shorter word has m letters, k = m // 2, either the first k
letters are equal and the edit comes after them, or the last m - k are equal and
the first k are not.  So a word goes to two buckets as the shorter one (or one of
two equals) and to two as the longer one, and every pair is found in exactly one.

*Index.*  Buckets lie in sorted order and whole buckets are joined to blocks.
For each (position, letter) a block has a bitset over its words.  The letters of
all asking words are followed at once: one bitset of words without an error so
far, and one each with one replaced, inserted and deleted letter, for which the
positions are shifted by one.  A step is a few operations on machine words.

*Hot buckets.*  A bucket of more than ``TILE`` words (and more than one in
``GROUPS`` of all rows, so at most ``GROUPS`` such keys are broadcast) is dealt to
pairs of tiles, which are tasks of their own.  Pairs are counted inside a block
and never written: a block returns one row per asking word.

*Roots.*  A form is ten times as frequent as its word, so chains are short;
they are followed by pointer doubling.

Defined results.  Null, empty or wordless texts give no words; a missing id is
empty text in the hash of planted edits.  Repeated rows count each.  Ties
between near words go to the smallest in code-point order.  Words may be of any
length and any letters but NUL.  An empty table gives an empty result; only the
named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voicetide.llm import base

#: Letters of a word, its least length and least number of occurrences.
LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 7
MIN_COUNT = 2
#: A form is at least so many times as frequent as its word.
RATIO = 10
#: Words and letters of a block; words of a tile; bound on the number of hot buckets.
BLOCK = 1024
BLOCK_LETTERS = 1 << 20
TILE = 16_384
GROUPS = 10_000
#: Distinct words counted in a task before they are sent on.
FLUSH = 500_000

COUNTS = "word string, n long"
FOUND = "word string, n_near long, best_n long, best string"
FULL = ~np.uint64(0)


def plain_counts(doc_id: str, text: str, pattern: re.Pattern, planted: int) -> Counter:
    """Words of one text with their counts; with ``planted``, a hash of id and word
    deletes one letter of every such-th word."""
    lower = text.encode("utf-8", "replace").lower().decode()  # A-Z only
    found = Counter(pattern.findall(lower))
    if not planted:
        return found
    start = zlib.crc32(f"{doc_id}:".encode())
    out: Counter = Counter()
    for run, n in found.items():
        h = zlib.crc32(run.encode(), start)
        if h % planted == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def words(docs: DataFrame, planted: int = 0, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): runs of letters of the texts, A-Z lower-cased, counted over all documents."""
    base.importable(docs.sparkSession)
    pattern = re.compile(f"[{LETTERS}]{{{min_length},}}")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), base.text_col().alias("text"))

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for piece in base.slices(batch, 1):
                for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    for word, n in plain_counts(doc_id, text, pattern, planted).items():
                        counts[word] += n
                if len(counts) > FLUSH:
                    yield batch_of(counts)
                    counts.clear()
        yield batch_of(counts)

    total = rows.mapInArrow(count, COUNTS).groupBy("word").agg(F.sum("n").alias("n"))
    return total.filter((F.col("n") >= min_count) & (F.length("word") >= min_length))


def placed(vocabulary: DataFrame) -> DataFrame:
    """(m, back, g, word, n): every word in the buckets of its length and the one below.

    ``back`` marks buckets of word ends; ``g`` is the hash of (m, back, letters).
    """
    size = F.length("word")
    rows = vocabulary.select("word", "n", F.explode(F.array(size, size - 1)).alias("m"))
    rows = rows.filter("m > 0").withColumn("half", F.floor(F.col("m") / 2).cast("int"))
    front = F.struct(F.lit(False).alias("back"), F.expr("left(word, half)").alias("key"))
    back = F.struct(F.lit(True).alias("back"), F.expr("right(word, m - half)").alias("key"))
    spread = rows.select("word", "n", "m", F.explode(F.array(front, back)).alias("p"))
    return spread.select("m", "p.back", F.xxhash64("m", "p.back", "p.key").alias("g"), "word", "n")


def dealt(rows: DataFrame, n_rows: int, tile: int = TILE, groups: int = GROUPS) -> DataFrame:
    """Adds ``asks`` and ``other``, and splits hot buckets into pairs of tiles."""
    most = max(tile, n_rows // groups)
    # fewer than ``groups`` buckets can hold more than their share of all rows
    hot = rows.groupBy("g").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > most)
    tiles = F.coalesce(F.ceil(F.col("size") / tile), F.lit(1)).cast("int")
    marked = rows.join(F.broadcast(hot), "g", "left").withColumn("tiles", tiles).drop("size")
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")

    def at(mine: Column, theirs: Column, asks: bool) -> Column:
        return F.struct(
            mine.alias("a"), theirs.alias("b"), F.lit(asks).alias("asks"), F.lit(not asks).alias("other")
        )

    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    both = F.concat(
        F.transform(every, lambda t: at(own, t, True)), F.transform(every, lambda t: at(t, own, False))
    )
    once = F.array(F.struct(
        F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(True).alias("asks"), F.lit(True).alias("other")
    ))
    spread = marked.withColumn("t", F.explode(F.when(F.col("tiles") == 1, once).otherwise(both)))
    return spread.select(
        "m", "back", F.when(F.col("tiles") > 1, F.xxhash64("g", "t.a", "t.b")).otherwise(F.col("g")).alias("g"),
        (F.col("tiles") > 1).alias("hot"), "word", "n", "t.asks", "t.other",
    )


class Index:
    """Bitsets over words: which of them have a letter at a position."""

    def __init__(self, codes: np.ndarray, letters: int):
        self.words = -(-len(codes) // 64)
        self.at = []
        for column in codes.T:
            hot = np.zeros((letters, self.words * 64), bool)
            hot[column, np.arange(len(column))] = True
            self.at.append(pack(hot))

    def having(self, position: int, letters: np.ndarray) -> np.ndarray:
        return self.at[position][letters]


def pack(flags: np.ndarray) -> np.ndarray:
    """Boolean rows (a multiple of 64 long) as 64-bit words."""
    return np.packbits(flags, axis=-1, bitorder="little").view("<u8")


def mask(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(-(-len(flags) // 64) * 64, bool)
    out[: len(flags)] = flags
    return pack(out)


def near_sets(
    index: Index, asked: np.ndarray, k: int, m: int, longer: bool, short: np.ndarray, long: np.ndarray
) -> np.ndarray:
    """Bitsets of the words at one edit from each asking word, the first k letters equal.

    ``asked`` holds letters of words of m letters, or of m + 1 if ``longer``;
    ``short`` and ``long`` mask the indexed words of m and of m + 1 letters.
    """
    none = np.full((len(asked), index.words), FULL, "<u8")
    for i in range(k):
        none &= index.having(i, asked[:, i])
    if longer:
        lacks = np.zeros_like(none)  # words that lack one letter of the asking word
        for i in range(k, m + 1):
            if i:
                lacks &= index.having(i - 1, asked[:, i])
            lacks |= none
            none &= index.having(i, asked[:, i])
        return lacks & short
    replaced, more = np.zeros_like(none), np.zeros_like(none)
    for i in range(k, m):
        here = index.having(i, asked[:, i])
        more = (more | none) & index.having(i + 1, asked[:, i])
        replaced = (replaced & here) | (none & ~here)
        none &= here
    return (replaced & short) | ((more | none) & long)


def reverse(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each word's letters from the last to the first, padded behind."""
    at = lengths[:, None] - 1 - np.arange(codes.shape[1])
    return np.where(at >= 0, np.take_along_axis(codes, np.maximum(at, 0), axis=1), 0)


def compare(
    m: int, back: bool, found: np.ndarray, counts: np.ndarray, asks: np.ndarray, other: np.ndarray
) -> list[tuple[str, int, int, str]]:
    """(word, near words, count and text of the best) of each asking word with near words."""
    k = m // 2
    lengths = np.char.str_len(found)
    letters = found.astype(f"U{m + 1}").view("<u4").reshape(len(found), m + 1)
    values, codes = np.unique(np.append(0, letters), return_inverse=True)
    codes = codes[1:].reshape(letters.shape)
    turned = reverse(codes, lengths) if back else codes
    rank = np.empty(len(found), np.int64)
    rank[np.lexsort((found, -counts))] = np.arange(len(found))
    by_rank = np.argsort(rank)
    n_near = np.zeros(len(found), np.int64)
    best = np.full(len(found), len(found))
    step = max(64, min(BLOCK, BLOCK_LETTERS // (m + 1)))
    others = np.flatnonzero(other)
    for start in range(0, len(others), step):
        these = others[start : start + step]
        index = Index(turned[these], len(values))
        fronts = Index(codes[these, :k], len(values)) if back else None
        short, long = mask(lengths[these] == m), mask(lengths[these] == m + 1)
        for longer in (False, True):
            asking = np.flatnonzero(asks & (lengths == m + longer))
            for first in range(0, len(asking), step):
                mine = asking[first : first + step]
                sets = near_sets(index, turned[mine], m - k if back else k, m, longer, short, long)
                if fronts is not None:
                    same = np.full_like(sets, FULL)
                    for i in range(k):
                        same &= fronts.having(i, codes[mine, i])
                    sets &= ~same
                row, column = np.nonzero(np.unpackbits(sets.view(np.uint8), axis=1, bitorder="little"))
                np.add.at(n_near, mine[row], 1)
                np.minimum.at(best, mine[row], rank[these[column]])
    hits = np.flatnonzero(n_near)
    chosen = by_rank[best[hits]]
    return list(zip(found[hits].tolist(), n_near[hits].tolist(), counts[chosen].tolist(), found[chosen].tolist(), strict=True))


def cuts(table: pa.Table) -> list[int]:
    """Ends of the blocks of sorted rows; what follows the last may go on in the next batch."""
    m, back, hot, g = (table.column(c).to_numpy() for c in ("m", "back", "hot", "g"))
    other_kind = (m[1:] != m[:-1]) | (back[1:] != back[:-1]) | hot[1:] | hot[:-1]
    new = (g[1:] != g[:-1]) | (m[1:] != m[:-1]) | (back[1:] != back[:-1])
    ends, forced = np.flatnonzero(new) + 1, np.flatnonzero(new & other_kind) + 1
    found, start = [], 0
    while True:
        enough = start + max(64, min(BLOCK, BLOCK_LETTERS // (int(m[start]) + 1)))
        i, j = np.searchsorted(ends, enough), np.searchsorted(forced, start, side="right")
        after = [*ends[i : i + 1].tolist(), *forced[j : j + 1].tolist()]
        if not after:
            return found
        start = min(after)
        found.append(start)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows in blocks of whole buckets of one kind; a pair of hot tiles is one alone."""
    kept: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if kept is not None:
            table = pa.concat_tables([kept, table]).combine_chunks()
        start = 0
        for end in cuts(table):
            yield table.slice(start, end - start)
            start = end
        kept = table.slice(start)
    if kept is not None:
        yield kept


def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in FOUND.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    rows: list[tuple] = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for block in blocks(batches):
        if block.num_rows > 1:
            found = np.array(block.column("word").to_pylist())
            n, asks, other = (block.column(c).to_numpy() for c in ("n", "asks", "other"))
            rows += compare(block.column("m")[0].as_py(), block.column("back")[0].as_py(), found, n, asks, other)
        if len(rows) > 8 * BLOCK:
            yield batch_of(rows)
            rows = []
    yield batch_of(rows)


def near_words(vocabulary: DataFrame, tile: int = TILE, groups: int = GROUPS) -> DataFrame:
    """(word, n_near, best_n, best): every word that has words at one edit, the number of
    these, and the most frequent one.  ``vocabulary`` has (word, n), words once."""
    base.importable(vocabulary.sparkSession)
    rows = dealt(placed(vocabulary), 4 * vocabulary.count(), tile, groups)
    order = ["m", "back", "hot", "g"]
    parts = rows.repartition("m", "back", "g").sortWithinPartitions(*order)
    found = parts.mapInArrow(search, FOUND).groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("_b")
    )
    return found.select("word", "n_near", (-F.col("_b.n")).alias("best_n"), F.col("_b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, by pointer doubling.

    ``forms`` has (word, form) without cycles.  A form has as many words as there are
    words at one edit of it, so no key of these joins is hot.
    """
    known = base.written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        following = known.toDF("root", "_next")
        further = known.join(following, "root", "left")
        known = base.written(
            further.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            "roots",
        )
        moved = known.filter("_moved").isEmpty()
        known = known.drop("_moved")
        if moved:
            return known


def variants(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``vocabulary`` (word, n)."""
    vocabulary = base.written(vocabulary, "words")
    best = near_words(vocabulary)
    takes = F.col("best_n") >= ratio * F.col("n")
    found = base.written(
        vocabulary.join(best, "word", "left").select(
            "word", F.when(takes, F.col("best")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(takes, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    followed = roots(found.filter("form IS NOT NULL"))
    return found.join(followed, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
