"""Document likelihood over a subword lattice.

The pieces and scores of an existing vocabulary give every word a lattice: all
ways to spell it as pieces.  Piece probabilities start from the vocabulary's
scores and are re-estimated on the training words (expectation maximisation over
all segmentations); a word's lattice probability is the log-space forward sum.
Words seen in training are arcs of their own beside their spellings, with
absolutely discounted relative frequencies.  For each language k of the training
texts

    P_k(w) = max(c_k - D_k, 0) / N_k
             + D_k V_k / N_k * (B c / N + (1 - B) S_k(w)),

S_k being the lattice distribution over words and the end of a text.  A text's
probability is the sum over k of the language's share and the product of P_k
over its tokens; its own language is not an input.  So the score sums the
probability of all ways to read the text.

Plan.  Word counts are combined in the map tasks and summed by word.  The
``HEAD_WORDS`` most frequent words (a fixed bound) travel to the tasks that scan
the texts; all other words of a text are joined with the word table and summed
by text.  Nothing else is broadcast, and no count is dropped.

Defined results.  Null or empty text: the end token alone.  Repeated rows and
repeated or missing ids: every row is scored by itself; a missing id is training
data (its crc32 is that of empty text).  No training rows: every word is unknown
and the score is the lattice's.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voicetide.llm import base, lattice, vocab

FOLDS = 7
HELD_OUT = 2
#: Words whose values the scanning tasks hold; the rest is joined.
HEAD_WORDS = 150_000
#: Words a map task counts before it hands the counts on.
COUNT_WORDS = 300_000
#: Words whose lattices a task works on at a time.
GATHERED_WORDS = 150_000
EM_STEPS = 3
#: Languages with a model of their own (those with most training texts); all other
#: training texts together are one more.
LANGUAGES = 8
#: Share of words of other languages among those that a language's training texts lack.
BORROWED = 0.1
#: Weight of the vocabulary's own scores against the corpus, in pieces.
PRIOR_PIECES = 300.0


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(base.id_crc(id_col), F.lit(FOLDS)) == HELD_OUT


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def languages(docs: DataFrame) -> list[str]:
    """The languages with most training texts, at most ``LANGUAGES``."""
    if "lang" not in docs.columns:
        return []
    found = docs.filter(~held_out() & F.col("lang").isNotNull()).groupBy("lang").count()
    return [r.lang for r in found.orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()]


def model_of(docs: DataFrame, langs: list[str]) -> Column:
    """The number of the model that a text trains."""
    if not langs:
        return F.lit(0)
    place = F.array_position(F.array(*map(F.lit, langs)), F.col("lang"))
    return F.when(place > 0, place - 1).otherwise(F.lit(len(langs))).cast("int")


def word_table(docs: DataFrame, langs: list[str]) -> DataFrame:
    """(word, c): all words of all texts with their counts in each model's training texts."""
    models = len(langs) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: list[Counter] = [Counter() for _ in range(models)]
        other: set[bytes] = set()

        def flush() -> pa.RecordBatch:
            held = [w for w in other if not any(w in c for c in counts)]
            names = [w for c in counts for w in c] + held
            model = [k for k, c in enumerate(counts) for _ in c] + [-1] * len(held)
            n = [n for c in counts for n in c.values()] + [0] * len(held)
            for c in (*counts, other):
                c.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(model, pa.int32()), pa.array(n, pa.int64())],
                names=["word", "model", "n"],
            )

        for batch in batches:
            for piece in base.slices(batch, 0):
                for text, k in zip(*[c.to_pylist() for c in piece.columns], strict=True):
                    (other if k < 0 else counts[k]).update(words(text))
                if len(other) + sum(map(len, counts)) > COUNT_WORDS:
                    yield flush()
        yield flush()

    model = F.when(held_out(), F.lit(-1)).otherwise(model_of(docs, langs)).alias("model")
    partial = docs.select("text", model).mapInArrow(count, "word binary, model int, n long")
    sums = [F.sum(F.when(F.col("model") == k, F.col("n")).otherwise(0)) for k in range(models)]
    return partial.groupBy("word").agg(F.array(*sums).alias("c"))


def initial(path: str) -> np.ndarray:
    """Log probabilities from the vocabulary's scores.

    A merge vocabulary scores by rank, the most frequent pieces first; ranks
    become probabilities by Zipf's law.  Byte pieces rank last.
    """
    pieces = vocab.pieces(path)
    usable = np.array(sorted(pieces.ids.values()))
    rank = np.full(pieces.size, float(pieces.size))
    order = usable[np.argsort(-pieces.score[usable], kind="stable")]
    rank[order] = np.arange(len(order))
    p = np.zeros(pieces.size)
    used = np.concatenate([usable, np.array([i for i in pieces.byte_id if i >= 0], int)])
    p[used] = 1 / (rank[used] + 2.7)
    return p / p.sum()


def normalised(counts: np.ndarray, path: str) -> np.ndarray:
    """Log probabilities of pieces that begin a word and of all others, each summing to one."""
    begins = np.array([t.startswith(vocab.SPACE) for t in vocab.pieces(path).text])
    begins = np.concatenate([begins, begins])
    p = np.where(begins, counts / counts[begins].sum(), counts / counts[~begins].sum())
    with np.errstate(divide="ignore"):
        return np.log(p)


def train(table: DataFrame, models: int, path: str, steps: int = EM_STEPS) -> list[np.ndarray]:
    """Each model's piece log probabilities, re-estimated on all of its training words.

    Each word counts once: how often it occurs is told by its own arc.  A step
    sums expected counts per piece; only one number per piece reaches the driver.
    """
    prior = np.tile(initial(path), 2) / 2
    given = [normalised(prior, path)] * models

    def expect(given: list[np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((models, len(prior)))
            for part in gathered(batches):
                counts = _matrix(part.column(1), models)
                for k in range(models):
                    seen = np.flatnonzero(counts[:, k])
                    found = part.column(0).take(pa.array(seen)).to_pylist()
                    total[k] += lattice.expected_counts(found, np.ones(len(found)), given[k], path)
            model, piece = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(model, pa.int64()), pa.array(piece, pa.int64()),
                 pa.array(total[model, piece], pa.float64())],
                names=["model", "piece", "n"],
            )

        return run

    for _ in range(steps):
        sums = (
            table.select("word", "c")
            .mapInArrow(expect(given), "model long, piece long, n double")
            .groupBy("model", "piece").agg(F.sum("n").alias("n")).toArrow()
        )
        counts = np.tile(PRIOR_PIECES * prior, (models, 1))
        at = sums["model"].to_numpy(), sums["piece"].to_numpy()
        np.add.at(counts, at, sums["n"].to_numpy())
        given = [normalised(c, path) for c in counts]
    return given


def gathered(batches: Iterator[pa.RecordBatch], rows: int = GATHERED_WORDS) -> Iterator[pa.RecordBatch]:
    """Batches of about ``rows`` rows: whole arrays of words are cheap, small ones are not."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if n:
        yield pa.concat_batches(held)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """An array of equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass(frozen=True)
class Totals:
    """Per model: training tokens and distinct tokens (ends included), texts, discounts."""

    tokens: np.ndarray
    distinct: np.ndarray
    texts: np.ndarray
    discount: np.ndarray
    #: Distinct tokens of all training texts.
    all_distinct: int

    @property
    def all_tokens(self) -> int:
        return int(self.tokens.sum())

    @property
    def weights(self) -> np.ndarray:
        """Share of each model among the training texts; equal shares without any."""
        total = self.texts.sum()
        return self.texts / total if total else np.full(len(self.texts), 1 / len(self.texts))

    @property
    def end(self) -> np.ndarray:
        """Each lattice's probability of the end of a text."""
        return (self.texts + 1) / (self.tokens + 2)

    def log10_p(self, counts: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """log10 of P_k for counts [token, model] and natural logs of S_k."""
        tokens = np.maximum(self.tokens, 1)
        seen = np.maximum(counts - self.discount, 0) / tokens
        left = np.where(self.tokens > 0, self.discount * self.distinct / tokens, 1.0)
        borrowed = BORROWED * counts.sum(axis=1, keepdims=True) / max(self.all_tokens, 1)
        with np.errstate(divide="ignore"):
            known = np.log(seen + left * borrowed)
            lattice_part = np.log(left * (1 - BORROWED)) + spelled
        return np.logaddexp(known, lattice_part) / math.log(10)

    def log10_words(self, counts: np.ndarray, log_lattice: np.ndarray) -> np.ndarray:
        return self.log10_p(counts, np.log1p(-self.end) + log_lattice)

    def log10_end(self) -> np.ndarray:
        return self.log10_p(self.texts[None, :], np.log(self.end)[None, :])[0]

    def log10_base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.all_tokens + self.all_distinct + 1))


def totals(table: DataFrame, docs: DataFrame, langs: list[str]) -> Totals:
    models = len(langs) + 1
    per_model = [
        [F.sum(c), F.count_if(c > 0), F.count_if(c == 1), F.count_if(c == 2)]
        for c in (F.col("c")[k] for k in range(models))
    ]
    found = table.agg(
        *[x for m in per_model for x in m], F.count_if(F.exists("c", lambda x: x > 0))
    ).first()
    sums = np.array([x or 0 for x in found[:-1]], np.int64).reshape(models, 4)
    texts = np.zeros(models, np.int64)
    for r in docs.filter(~held_out()).groupBy(model_of(docs, langs).alias("k")).count().collect():
        texts[r.k] = r["count"]
    once, twice = sums[:, 2], sums[:, 3]
    discount = np.where(once + twice > 0, once / np.maximum(once + 2 * twice, 1), 0.5)
    return Totals(
        sums[:, 0] + texts, sums[:, 1] + (texts > 0), texts, np.clip(discount, 0.1, 0.9),
        int(found[-1]) + int(texts.sum() > 0),
    )


def with_values(
    table: DataFrame, log_p: list[np.ndarray], sums: Totals, path: str
) -> DataFrame:
    """(word, n, base, lp): training count, and what each occurrence adds to the scores."""
    models = len(log_p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches):
            counts = _matrix(part.column(1), models)
            spelled = lattice.log_likelihood(part.column(0).to_pylist(), log_p, path)
            scores = sums.log10_words(counts, spelled)
            n = counts.sum(axis=1)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(n) + 1) * models, pa.int32()), pa.array(scores.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n), pa.array(sums.log10_base(n)), lists],
                names=["word", "c", "base", "lp"],
            )

    return table.select("word", "c").mapInArrow(
        run, "word binary, c long, base double, lp array<double>"
    )


def most_frequent(values: DataFrame, most: int) -> pa.Table:
    """The words down to the count at which they are still no more than ``most``.

    The count comes from a histogram, so only those words leave the executors.
    """
    sizes = values.groupBy(F.floor(8 * F.log2(1 + F.col("c"))).alias("k")).count().collect()
    total, least = 0, None
    for k, n in sorted(((r.k, r["count"]) for r in sizes), reverse=True):
        total += n
        if total > most:
            break
        least = k
    if least is None:
        return values.limit(0).toArrow()
    return values.filter(F.floor(8 * F.log2(1 + F.col("c"))) >= least).toArrow()


SCANNED = (
    "row long, doc_id long, held_out boolean, n_tokens long, word binary, n long, "
    "known long, base double, lp array<double>"
)
_KINDS = {
    "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64(),
    "array<double>": pa.list_(pa.float64()),
}
SCHEMA = pa.schema([(n, _KINDS[k]) for n, k in (c.split() for c in SCANNED.split(", "))])


def scan(docs: DataFrame, head: pa.Table, models: int) -> DataFrame:
    """Two kinds of rows: per text the sums over the head's words (``word`` null), and
    per text and other word its count."""
    head = head.combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: i for i, w in enumerate(head["word"].to_pylist())}
        seen = head["c"].to_numpy() > 0
        bases = head["base"].to_numpy()
        scores = (
            _matrix(head["lp"].combine_chunks(), models) if place else np.zeros((0, models))
        )
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for piece in base.slices(batch, 0):
                out: list[tuple] = []
                for text, doc_id, held in zip(*[c.to_pylist() for c in piece.columns], strict=True):
                    counts = Counter(words(text))
                    at, times = [], []
                    for word, n in counts.items():
                        i = place.get(word)
                        if i is None:
                            out.append((row, None, None, None, word, n, None, None, None))
                        else:
                            at.append(i)
                            times.append(n)
                    index, n = np.array(at, np.int64), np.array(times, np.int64)
                    out.append((
                        row, doc_id, held, counts.total() + 1, None, None,
                        int(n[seen[index]].sum()), float(n @ bases[index]), n @ scores[index],
                    ))
                    row += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), SCHEMA, strict=True)],
                    schema=SCHEMA,
                )

    return docs.select("text", F.col("doc_id").cast("long"), held_out()).mapInArrow(run, SCANNED)


def score(docs: DataFrame, path: str | None = None, head_words: int = HEAD_WORDS) -> DataFrame:
    """One row per text: counts, ``base_score`` and ``score``."""
    path = path or vocab.default_pieces()
    langs = languages(docs)
    models = len(langs) + 1
    table = base.written(word_table(docs, langs), "words")
    sums = totals(table, docs, langs)
    values = base.written(with_values(table, train(table, models, path), sums, path), "values")
    head = most_frequent(values, head_words)
    scanned = base.written(scan(docs, head, models), "scanned")
    n = F.col("n")
    others = (
        scanned.filter("word IS NOT NULL").select("row", "word", "n")
        .join(values, "word")
        .groupBy("row")
        .agg(
            F.sum(n * F.col("base")).alias("o_base"),
            F.sum(F.when(F.col("c") > 0, n).otherwise(0)).alias("o_known"),
            *[F.sum(n * F.col("lp")[k]).alias(f"o_lp{k}") for k in range(models)],
        )
    )
    ends, weights = sums.log10_end(), sums.weights
    by_model = [
        F.col("lp")[k] + F.coalesce(f"o_lp{k}", F.lit(0.0))
        + float(ends[k]) + float(np.log10(weights[k]))
        for k in range(models) if weights[k] > 0
    ]
    best = F.array_max(F.array(*by_model))
    summed = F.aggregate(
        F.array(*by_model), F.lit(0.0), lambda a, x: a + F.pow(F.lit(10.0), x - best)
    )
    end_base = float(sums.log10_base(np.array(sums.texts.sum())))
    return (
        scanned.filter("word IS NULL").drop("word", "n").join(others, "row", "left")
        .select(
            "doc_id", "held_out", "n_tokens",
            (F.col("known") + F.coalesce("o_known", F.lit(0)) + int(sums.texts.sum() > 0))
            .alias("n_known"),
            F.lit(sums.all_tokens).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("o_base", F.lit(0.0)) + end_base).alias("base_score"),
            (best + F.log10(summed)).alias("score"),
        )
    )
