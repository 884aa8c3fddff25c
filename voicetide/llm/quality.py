"""Robust multivariate outliers: minimum covariance determinant per language and source.

Every text gives a vector of transformed statistics.  For each (lang, source)
the minimum-covariance-determinant estimate is found by concentration steps
over all of its rows, and a document is rejected when its squared Mahalanobis
distance is beyond ``cutoff``.  A step is one partial aggregation: squared
distances fall into logarithmic bins, moments are summed per (group, bin), and
the bins nearest to the centre that hold the share ``H`` of the group give the
next estimate.  So a group of any size is spread over all tasks, and only
``BINS`` rows of it ever meet.  Two deterministic starts are run (the group's
and its language's quartiles); the smaller determinant stays.

Defined results.  Null text: no words, so ``base_failed``.  Null language or
source: a group of its own.  Repeated rows: each is judged by itself and counts.
Small groups lean on their language's quartiles with the weight of
``PRIOR_ROWS`` rows.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voicetide.llm import base

MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

#: Share of a group that the estimate rests on, its consistency factor for a
#: four-dimensional normal, and the number of concentration steps.
H = 0.75
STEPS = 6
CONSISTENCY = 1.487
#: Rows of the language's estimate added to each group's.
PRIOR_ROWS = 20.0
BINS = 255
#: Rejection bound: the upper 1e-6 point of chi-squared with four degrees of freedom.
CUTOFF = 33.4

#: Statistic -> the spread every group is granted at least.  Its square is added
#: to the variance, so that a statistic that is constant in a group (no symbols
#: at all, say) neither makes the matrix singular nor rejects a trifle.
FEATURES = {"word_length": 0.1, "symbols": 0.2, "repeated_lines": 0.3, "repeated_words": 0.4}
DIM = len(FEATURES)
NAMES = tuple(FEATURES)

STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, "
    "n_repeat_words long"
)


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that are found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    size = len(ids)
    if size < 2_000_000:
        windows = (codes[:-2] * size + codes[1:-1]) * size + codes[2:]
    else:  # three ids don't fit into 63 bits: number the pairs first
        _, pairs = np.unique(codes[:-1] * size + codes[1:], return_inverse=True)
        windows = pairs[:-1] * size + codes[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    found = np.zeros(n - 2, bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= found
    return int(covered.sum())


def text_stats(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The values of ``STATS`` for one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    joined = b"".join(words)
    chars = len(joined) if text.isascii() else len(joined.decode("utf-8", "surrogatepass"))
    lines = [x for x in raw.split(b"\n") if not x.isspace() and x]
    symbols = sum(raw.count(c) for c in map(str.encode, SYMBOLS))
    return (
        len(words), chars, symbols, len(lines) - len(set(lines)), len(lines), repeat_words(words)
    )


def add_stats(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` and the counts of ``STATS``; one narrow Python pass over ``text``."""

    def make(texts: list[str | None]) -> tuple[None, Iterable]:
        return None, zip(*map(text_stats, texts), strict=True)

    return base.add_columns(docs, make, STATS, ["text"], keep)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )


def vector() -> list[Column]:
    """The transformed statistics, in the order of ``FEATURES``."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    return [
        F.log(chars / words).alias("word_length"),
        F.log1p(100 * F.col("n_symbols") / chars).alias("symbols"),
        F.log1p(10 * F.col("n_dup_lines") / lines).alias("repeated_lines"),
        F.log1p(10 * F.col("n_repeat_words") / words).alias("repeated_words"),
    ]


def _quartiles(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Medians and spreads per key, as the first centre and matrix."""
    found = rows.groupBy(*keys).agg(
        *[F.percentile_approx(c, [0.25, 0.5, 0.75], 2000).alias(c) for c in NAMES]
    )
    floor = list(FEATURES.values())
    spread = [
        F.pow((F.col(c)[2] - F.col(c)[0]) / 1.349, 2) + F.lit(floor[i] ** 2)
        for i, c in enumerate(NAMES)
    ]
    return found.select(
        *keys,
        F.array(*[F.col(c)[1].cast("double") for c in NAMES]).alias("center"),
        F.array(
            *[spread[i] if i == j else F.lit(0.0) for i in range(DIM) for j in range(DIM)]
        ).alias("cov"),
        F.array(
            *[1 / spread[i] if i == j else F.lit(0.0) for i in range(DIM) for j in range(DIM)]
        ).alias("inverse"),
    )


def distance(center: str = "center", inverse: str = "inverse") -> Column:
    """Squared Mahalanobis distance of the statistics."""
    gap = [F.col(c) - F.col(center)[i] for i, c in enumerate(NAMES)]
    terms = [
        (1 if i == j else 2) * gap[i] * gap[j] * F.col(inverse)[i * DIM + j]
        for i in range(DIM)
        for j in range(i, DIM)
    ]
    return F.greatest(sum(terms[1:], terms[0]), F.lit(0.0))


PARAMS = (
    "lang string, source string, start int, prior_center array<double>, prior_cov array<double>, "
    "center array<double>, inverse array<double>, log_det double"
)
PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]


def _concentrate(bins: pd.DataFrame) -> pd.DataFrame:
    """The next estimate of one (group, start) from its at most ``BINS`` + 1 bins."""
    bins = bins.sort_values("bin")
    counts = bins["n"].to_numpy(float)
    need = math.ceil(H * counts.sum())
    last = int(np.searchsorted(np.cumsum(counts), need))
    total = bins.iloc[: last + 1].sum(numeric_only=True)
    n, first = float(total["n"]), bins.iloc[0]
    prior_center = np.array(first["prior_center"], float)
    prior_cov = np.array(first["prior_cov"], float).reshape(DIM, DIM)
    # sums are taken around the prior's centre, so nothing cancels
    shift = np.array([total[f"s{i}"] for i in range(DIM)]) / n
    second = np.zeros((DIM, DIM))
    for i, j in PAIRS:
        second[i, j] = second[j, i] = total[f"s{i}_{j}"] / n
    cov = CONSISTENCY * (second - np.outer(shift, shift))
    floor = np.diag(np.array(list(FEATURES.values())) ** 2)
    weight = n / (n + PRIOR_ROWS)
    center = prior_center + weight * shift
    cov = weight * (cov + floor) + (1 - weight) * prior_cov
    inverse = np.linalg.inv(cov)
    return pd.DataFrame(
        {
            "lang": [first["lang"]], "source": [first["source"]], "start": [first["start"]],
            "prior_center": [prior_center], "prior_cov": [prior_cov.ravel()],
            "center": [center], "inverse": [inverse.ravel()],
            "log_det": [float(np.linalg.slogdet(cov)[1])],
        }
    )


def estimates(stats: DataFrame) -> DataFrame:
    """(lang, source) -> centre and inverse matrix, from rows with ``FEATURES``."""
    keys = ["lang", "source"]
    own = _quartiles(stats, keys)
    pooled = _quartiles(stats, ["lang"]).select(
        F.col("lang").alias("_lang"),
        *[F.col(c).alias(f"prior_{c}") for c in ("center", "cov", "inverse")],
    )
    both = own.join(pooled, F.col("lang").eqNullSafe(F.col("_lang")))
    starts = F.explode(
        F.array(
            F.struct(F.lit(0).alias("start"), "center", "inverse"),
            F.struct(
                F.lit(1).alias("start"),
                F.col("prior_center").alias("center"),
                F.col("prior_inverse").alias("inverse"),
            ),
        )
    )
    params = both.select(*keys, "prior_center", "prior_cov", starts.alias("_s")).select(
        *keys, "_s.start", "prior_center", "prior_cov", "_s.center", "_s.inverse",
        F.lit(None).cast("double").alias("log_det"),
    )
    for _ in range(STEPS):
        placed = _with_params(stats, base.written(params, "mcd"), keys)
        gap = [F.col(c) - F.col("prior_center")[i] for i, c in enumerate(NAMES)]
        binned = placed.withColumn(
            "bin", F.least(F.floor(16 * F.log2(1 + distance())), F.lit(BINS)).cast("int")
        )
        sums = binned.groupBy(*keys, "start", "bin").agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.first("prior_center").alias("prior_center"),
            F.first("prior_cov").alias("prior_cov"),
            *[F.sum(gap[i]).alias(f"s{i}") for i in range(DIM)],
            *[F.sum(gap[i] * gap[j]).alias(f"s{i}_{j}") for i, j in PAIRS],
        )
        params = sums.groupBy(*keys, "start").applyInPandas(_concentrate, PARAMS)
    best = params.groupBy(*keys).agg(
        F.min(F.struct("log_det", "start", "center", "inverse")).alias("_b")
    )
    return best.select(*keys, "_b.center", "_b.inverse")


def _with_params(rows: DataFrame, params: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe join on the group; Spark broadcasts the groups if they are few."""
    theirs = params.select(
        *[F.col(k).alias(f"_{k}") for k in keys], *[c for c in params.columns if c not in keys]
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return rows.join(theirs, same, "left").drop(*[f"_{k}" for k in keys])


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``distance``, ``kept``.

    Needs ``doc_id``, ``text``, ``lang`` and ``source``; texts are read once,
    all steps run on the written statistics.
    """
    scored = add_stats(docs, ["doc_id", "lang", "source"])
    stats = base.written(scored.select("*", base_failed().alias("base_failed"), *vector()), "stats")
    params = base.written(estimates(stats.filter(~F.col("base_failed"))), "mcd")
    placed = _with_params(stats, params, ["lang", "source"])
    far = distance()
    return placed.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", far.alias("distance"),
        (~F.col("base_failed") & F.coalesce(far <= cutoff, F.lit(False))).alias("kept"),
    )


def keep_clean(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The documents that ``judge`` keeps, with the columns they came with.

    The verdict depends only on a row's text, language and source.  Texts are
    read twice, once for the estimates and once for the verdicts: nothing wide
    is written or shuffled, and repeated or missing ids do no harm.
    """
    own = [f.name for f in T.StructType.fromDDL(STATS)] + list(NAMES)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "lang", "source", "text"
    )
    scored = add_stats(rows, ["lang", "source"]).filter(~base_failed())
    vectors = base.written(scored.select("lang", "source", *vector()), "stats")
    params = base.written(estimates(vectors), "mcd")
    again = add_stats(rows, ["_row", "lang", "source"]).filter(~base_failed())
    placed = _with_params(again.select("*", *vector()), params, ["lang", "source"])
    return placed.filter(distance() <= cutoff).drop(*own).select("_row.*")
