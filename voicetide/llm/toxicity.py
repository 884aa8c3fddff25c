"""Toxic passages as maximum-scoring segments of token log-odds.

*Token scores* (a bounded sample of labelled rows): how many documents with and
without the label hold a word, or a beginning of words, gives its log-odds under
an informative Dirichlet prior: ``PRIOR`` pseudo-documents of each class in which
the token is as frequent as in both.  The log-odds are moved towards zero by
``SHRINK`` standard errors.  A token has the score of the longest known feature of
it, evidence for as well as against; one constant is taken from every token's
score, such that the scores' exponentials have mean one in clean text.

*Segments*: one linear scan per text finds all maximal scoring segments.  With such
scores the best segment of n clean tokens follows an extreme-value law,
P(S >= s) = 1 - exp(-K n e^-s).  A segment is significant when S > ln(K n); the
excesses of all significant segments add up, and a logistic curve turns the sum
into the score.  The constant, K and the curve come from a quarter of the sample's
texts, which the token scores are not learnt from.

Defined results.  Null or empty text: no segment, the least evidence.  Repeated
rows: the same score each.  Missing labels: unlabelled; contradicting labels of one
id: the largest.  Labels of one class only: no token scores, the share of that
class.  No usable label at all: score 0.25.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voicetide.llm import base

#: Labelled rows the model is fitted on, those with the smallest hash of their id.
MAX_FIT_ROWS = 40_000
#: Features in the model (those with the most evidence), which bounds the broadcast.
MAX_FEATURES = 100_000
#: Pseudo-documents of each class, standard errors of shrinkage, least documents of a feature.
PRIOR = 50.0
SHRINK = 1.0
MIN_DOCS = 5
#: Word beginnings that are features beside the word: they stand in for rare inflections.
PREFIXES = (6, 5, 4)
#: One in so many texts of the sample calibrates and isn't learnt from.
CALIBRATING = 4
#: With fewer such texts, or none of a class, all texts calibrate.
MIN_CALIBRATING = 50
STRIP = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))
CACHE_WORDS = 400_000
FOLDS = 5
#: Evidence of a text far below the bound of significance.
LEAST = -3.0

SEGMENT = "array<struct<first:int,last:int,score:double,e_value:double>>"


def features(word: str) -> list[str]:
    """A token and its beginnings, the most specific first."""
    token = word.strip(STRIP)
    found = [token] if len(token) > 1 else []
    found += [f"{token[:n]}*" for n in PREFIXES if len(token) > n]
    return found


class Scores(dict):
    """Word -> its score; filled on demand and bounded."""

    def __init__(self, model: Model):
        super().__init__()
        self.weights, self.gap = model.weights, model.gap

    def __missing__(self, word: str) -> float:
        if len(self) > CACHE_WORDS:
            self.clear()
        weights = self.weights
        self[word] = value = next((weights[f] for f in features(word) if f in weights), 0.0) + self.gap
        return value


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), in one pass.

    A stack holds disjoint candidates with the cumulative sums before and after
    each.  A new candidate whose sum after is larger than that of the nearest one
    with a smaller sum before swallows all from there on.
    """
    hits = np.flatnonzero(scores > 0)
    after_all = np.cumsum(scores)
    ends = after_all[hits]
    stack: list[tuple[int, int, float, float]] = []
    for position, after, score in zip(hits.tolist(), ends.tolist(), scores[hits].tolist(), strict=True):
        first, start = position, after - score
        kept = len(stack)
        while True:
            j = kept - 1
            while j >= 0 and stack[j][2] >= start:
                j -= 1
            if j < 0 or stack[j][3] >= after:
                break
            first, start = stack[j][0], stack[j][2]
            kept = j
        del stack[kept:]
        stack.append((first, position, start, after))
    return [(a, b, end - start) for a, b, start, end in stack]


@dataclass(frozen=True)
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    gap: float = -0.1
    log_k: float = 0.0
    intercept: float = -math.log(3)
    slope: float = 0.0

    def scan(self, text: str | None, scores: Scores) -> tuple[int, list[tuple[int, int, float]]]:
        words = (text or "").lower().split()
        return len(words), segments(np.fromiter(map(scores.__getitem__, words), float, len(words)))

    def bound(self, n: int) -> float:
        return self.log_k + math.log(max(n, 1))

    def significant(self, n: int, found: list[tuple[int, int, float]]) -> list[tuple]:
        """Segments beyond the extreme-value bound, with their expected number in clean text."""
        bound = self.bound(n)
        return [(a, b, s, math.exp(min(bound - s, 50.0))) for a, b, s in found if s > bound]

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> float:
        """The logarithm of the summed excesses, or how far the best segment is from the bound."""
        bound = self.bound(n)
        excess = sum(s - bound for _, _, s in found if s > bound)
        if excess > 0:
            return math.log1p(excess)
        return max((max(s for _, _, s in found) - bound) / 10, LEAST) if found else LEAST

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-(self.intercept + self.slope * evidence)))


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(base.id_crc(id_col), F.lit(FOLDS)) == 0


def fit_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, calibrates): labelled texts outside the held-out fold, equal texts once."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    known = base.hash_sample(
        usable.groupBy("doc_id").agg(F.max("toxic").alias("_toxic")), ["doc_id"], MAX_FIT_ROWS
    )
    # at most MAX_FIT_ROWS pairs of numbers are broadcast
    rows = docs.select("doc_id", base.text_col().alias("text")).join(F.broadcast(known), "doc_id")
    texts = (
        rows.groupBy(F.md5(F.col("text").cast("binary")), F.length("text"))
        .agg(F.max(F.struct("_toxic", "text")).alias("_r"))
        .select(F.col("_r.text").alias("text"), (F.col("_r._toxic") > 0).cast("int").alias("toxic"))
    )
    return texts.withColumn("calibrates", F.pmod(F.xxhash64("text"), F.lit(CALIBRATING)) == 0)


def _count(texts: list[str], toxic: list[int]) -> tuple[None, list[list]]:
    counts: tuple[dict, dict] = ({}, {})
    made: dict[str, list[str]] = {}
    for text, label in zip(texts, toxic, strict=True):
        count = counts[bool(label)]
        found: set[str] = set()
        for word in set(text.lower().split()):
            if word not in made:
                made[word] = features(word)
            found.update(made[word])
        for f in found:
            count[f] = count.get(f, 0) + 1
    names = list(counts[0].keys() | counts[1].keys())
    return None, [names, [counts[1].get(f, 0) for f in names], [counts[0].get(f, 0) for f in names]]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Token scores from document counts, then calibration on texts they aren't learnt from.

    Only bounded data reach the driver: ``MAX_FEATURES`` features, and two numbers and
    a label for each of at most ``MAX_FIT_ROWS`` rows.
    """
    rows = base.written(fit_rows(docs, labels), "fit")
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model()
    learnt = rows.filter("NOT calibrates")
    by_class = {r.toxic: r.n for r in learnt.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(by_class) < 2:
        share = (sizes.get(1, 0) + 0.5) / (sum(sizes.values()) + 2)
        return Model(intercept=math.log(share / (1 - share)))
    counted = base.add_columns(
        learnt, _count, "feature string, a long, b long", ["text", "toxic"], []
    ).groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    prior = PRIOR * (F.col("a") + F.col("b")) / (by_class[1] + by_class[0])
    a, b = F.col("a") + prior, F.col("b") + prior
    odds = F.log(a / (by_class[1] + PRIOR + 1 - a)) - F.log(b / (by_class[0] + PRIOR + 1 - b))
    error = F.sqrt(1 / a + 1 / b)
    found = (
        counted.filter(F.col("a") + F.col("b") >= MIN_DOCS)
        .select("feature", odds.alias("odds"), error.alias("error"))
        .filter(F.abs("odds") > SHRINK * F.col("error"))
        .orderBy(F.desc(F.abs("odds") / F.col("error")), "feature")
        .limit(MAX_FEATURES)
        .collect()
    )
    weights = {r.feature: math.copysign(abs(r.odds) - SHRINK * r.error, r.odds) for r in found}
    apart = {t: sizes.get(t, 0) - by_class.get(t, 0) for t in (0, 1)}
    enough = min(apart.values()) > 0 and sum(apart.values()) >= MIN_CALIBRATING
    return _calibrated(Model(weights, gap=0.0), rows.filter("calibrates") if enough else rows)


def _measured(rows: DataFrame, model: Model, names: str, measure: Callable) -> DataFrame:
    """The numbers that ``measure`` makes of each text, and its label."""

    def make(texts: list[str], toxic: list[int]) -> tuple[None, list[list]]:
        scores = Scores(model)
        return None, [*map(list, zip(*[measure(t, scores) for t in texts], strict=True)), toxic]

    return base.add_columns(rows, make, f"{names}, toxic int", ["text", "toxic"], [])


def _calibrated(model: Model, rows: DataFrame) -> Model:
    """The constant and K from the clean rows, the curve from all of them."""

    def mass(text: str, scores: Scores) -> tuple[int, float]:
        words = text.lower().split()
        return len(words), sum(math.exp(scores[w]) for w in words)

    total = _measured(rows, model, "n long, mass double", mass).filter("toxic = 0").agg(
        F.sum("n").alias("n"), F.sum("mass").alias("mass")
    ).first()
    # a text without toxic words drifts downwards in any case
    gap = -max(math.log(total.mass / total.n), 0.0) - 0.05 if total.n else -0.1
    model = replace(model, gap=gap)

    def best(text: str, scores: Scores) -> tuple[int, float]:
        n, found = model.scan(text, scores)
        return n, max((s for _, _, s in found), default=0.0)

    seen = _measured(rows, model, "n long, best double", best).filter("toxic = 0").collect()
    # n e^-S is exponential with rate K; texts without a segment are censored at zero
    exposure = sum(r.n * math.exp(-r.best) for r in seen)
    events = 0.5 + sum(r.best > 0 for r in seen)
    model = replace(model, log_k=math.log(events / max(exposure, 1e-9)) if seen else 0.0)

    def evidence(text: str, scores: Scores) -> tuple[float]:
        return (model.evidence(*model.scan(text, scores)),)

    found = _measured(rows, model, "x double", evidence).collect()
    x, y = np.array([r.x for r in found], float), np.array([r.toxic for r in found], float)
    intercept, slope = _logistic(x, y)
    return replace(model, intercept=intercept, slope=slope)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Newton's method; the ridge on the slope keeps it finite when classes separate."""
    design = np.c_[np.ones_like(x), x]
    w = np.array([math.log((y.sum() + 0.5) / (len(y) - y.sum() + 1.5)), 0.0])
    penalty = np.diag([1e-3, ridge])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -50, 50)))
        gradient = design.T @ (y - p) - penalty @ w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty
        step = np.linalg.solve(hessian, gradient)
        w = w + step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0))


def score(docs: DataFrame, model: Model, keep: list[str], passages: bool = True) -> DataFrame:
    """The columns ``keep``, ``score`` and, if asked for, the significant ``passages``
    (positions of first and last word, score, expected number in clean text)."""

    def make(texts: list[str | None]) -> tuple[None, list[list]]:
        scores = base.kept(("toxic scores",), lambda: Scores(model))
        probabilities, spans = [], []
        for text in texts:
            n, found = model.scan(text, scores)
            probabilities.append(model.probability(model.evidence(n, found)))
            if passages:
                spans.append([
                    {"first": a, "last": b, "score": s, "e_value": e}
                    for a, b, s, e in model.significant(n, found)
                ])
        return None, [probabilities, spans] if passages else [probabilities]

    added = "score double" + (f", passages {SEGMENT}" if passages else "")
    return base.add_columns(docs, make, added, ["text"], keep)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``held_out``, ``score``, ``predicted`` and the passages."""
    scored = score(docs, fit(docs, labels), ["doc_id"])
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages",
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents scored below one half, with the columns they came with."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")
    scored = score(rows, fit(docs, labels), ["_row"], passages=False)
    return scored.filter(F.col("score") < 0.5).select("_row.*")
