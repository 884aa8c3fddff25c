"""Terms of tokenised texts, counted with Arrow and numpy inside tasks.

Words are looked up once per batch in a list that is shipped to the tasks; pairs are
two such numbers side by side.  Nothing but terms of the list is ever written as text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voicetide.session import importable

#: Texts counted at once: a table of this many rows by the number of terms.
ROWS = 1024


def known_words(words: pa.Array, among: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the words in ``among``: text, place over all texts, number in ``among``."""
    lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    flat = words.flatten()
    ids = pc.fill_null(pc.index_in(flat, value_set=among.cast(flat.type)), -1).to_numpy(zero_copy_only=False)
    place = np.flatnonzero(ids >= 0)
    return np.repeat(np.arange(len(words)), lengths)[place], place, ids[place].astype(np.int64)


def adjacent(text: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which known words are followed by another one of the same text."""
    return np.flatnonzero((place[1:] - place[:-1] == 1) & (text[1:] == text[:-1]))


def pair_counts(words: pa.Array, among: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words of ``among`` as one number each, and how often they occur; slices of texts bound the memory."""
    found = [np.zeros(0, np.int64)]
    for start in range(0, len(words), ROWS):
        text, place, ids = known_words(words.slice(start, ROWS), among)
        at = adjacent(text, place)
        found.append(ids[at] * len(among) + ids[at + 1])
    return np.unique(np.concatenate(found), return_counts=True)


def pairs_among(tokens: DataFrame, frequent: Sequence[str]) -> DataFrame:
    """(_a, _b, n): pairs of frequent words, counted per batch."""
    importable(tokens.sparkSession)
    names = list(frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        among = pa.array(names, pa.string())
        for batch in batches:
            pairs, n = pair_counts(batch.column(0), among)
            first, second = np.divmod(pairs, len(names))
            yield pa.RecordBatch.from_arrays(
                [among.take(pa.array(first)), among.take(pa.array(second)), pa.array(n, pa.int64())], ["_a", "_b", "n"]
            )

    return tokens.select("_words").mapInArrow(count, "_a string, _b string, n long")


class TermCounter:
    """Counts the terms of a vocabulary of words and pairs (two words and a space)."""

    def __init__(self, terms: Sequence[str]):
        parts = [t.split(" ") for t in terms]
        self.size = len(terms)
        self.words = sorted({w for p in parts for w in p})
        number = {w: i for i, w in enumerate(self.words)}
        self.single = np.full(len(self.words), -1)
        found = []
        for i, p in enumerate(parts):
            if len(p) == 1:
                self.single[number[p[0]]] = i
            else:
                found.append((number[p[0]] * len(self.words) + number[p[1]], i))
        found.sort()
        self.codes = np.array([c for c, _ in found], np.int64)
        self.of_code = np.array([i for _, i in found], np.int64)

    def counts(self, words: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per slice of texts: their number, then text, term and count in this order."""
        among = pa.array(self.words, pa.string())
        for start in range(0, len(words), ROWS):
            piece = words.slice(start, ROWS)
            text, place, ids = known_words(piece, among)
            term = self.single[ids]
            cells = [(text * self.size + term)[term >= 0]]
            if len(self.codes):
                at = adjacent(text, place)
                code = ids[at] * len(self.words) + ids[at + 1]
                near = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
                hit = self.codes[near] == code
                cells.append((text[at] * self.size + self.of_code[near])[hit])
            table = np.bincount(np.concatenate(cells).astype(np.int64), minlength=len(piece) * self.size)
            cell = np.flatnonzero(table)
            yield len(piece), cell // self.size, cell % self.size, table[cell]


def document_frequencies(tokens: DataFrame, terms: Sequence[str]) -> tuple[int, np.ndarray]:
    """The number of texts, and of texts with each term."""
    importable(tokens.sparkSession)
    counter = TermCounter(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(counter.size + 1, np.int64)
        for batch in batches:
            for n, _, term, _ in counter.counts(batch.column(0)):
                total[:-1] += np.bincount(term, minlength=counter.size)
                total[-1] += n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["term", "n"])

    found = tokens.select("_words").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(counter.size + 1, np.int64)
    for r in found.collect():  # one row a term
        out[r.term] = r.n
    return int(out[-1]), out[:-1]


def unit_vectors(terms: Sequence[str], weights: np.ndarray) -> Callable[[str], Column]:
    """Sparse vectors of a column of words: counts by ``weights``, of length one."""
    counter = TermCounter(terms)

    def vectors(words: pa.Array) -> pa.Array:
        lengths, indices, values = [np.zeros(1, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0)]
        for n, text, term, count in counter.counts(words):
            weighted = count * weights[term]
            norm = np.sqrt(np.bincount(text, weighted * weighted, minlength=n))
            lengths.append(np.bincount(text, minlength=n))
            indices.append(term.astype(np.int32))
            values.append(weighted / norm[text])
        ends = pa.array(np.cumsum(np.concatenate(lengths)), pa.int32())
        return pa.StructArray.from_arrays(
            [
                pa.array(np.zeros(len(words), np.int8)), pa.array(np.full(len(words), counter.size, np.int32)),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(indices))),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(values))),
            ],
            ["type", "size", "indices", "values"],
        )

    # named types are no text here, as annotations are in this module
    vectors.__annotations__ = {"words": pa.Array, "return": pa.Array}
    return F.arrow_udf(vectors, VectorUDT())
