"""Row predicates.  Bounds, words and thresholds are arguments."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voicetide.config import FocusRule


def once(value: Column, condition: Callable[[Column], Column]) -> Column:
    """``condition`` of a value that is written into the plan a single time.

    Spark moves filters below projections and copies the projected expression
    to every place the filter names it.  For a value that is costly to compute
    (a parsed date, a normalised text) that would be many computations per row.
    """
    return F.exists(F.array(value), condition)


def contains_word(text: Column, word: str) -> Column:
    """Case-insensitive substring; null text does not match."""
    return F.coalesce(F.lower(text).contains(word.lower()), F.lit(False))


def _any_word(lowered: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [lowered.contains(w.lower()) for w in words], F.lit(False))


def focus_predicate(lowered: Column, rule: FocusRule) -> Column:
    """Rule on a lower-case text."""
    off_topic = _any_word(lowered, rule.excluded) & ~_any_word(lowered, rule.rescue)
    return lowered.contains(rule.keyword.lower()) & ~off_topic


def focus_filter(posts: DataFrame, rules: Mapping[str, FocusRule]) -> DataFrame:
    """Apply each brand's focus rule; brands without a rule are dropped."""

    def keep(lowered: Column) -> Column:
        parts = [
            (F.col("brand") == brand) & focus_predicate(lowered, rule)
            for brand, rule in rules.items()
        ]
        return reduce(lambda a, b: a | b, parts, F.lit(False))

    on_brand = F.col("brand").isin(list(rules))
    return posts.filter(on_brand & once(F.lower("text"), keep))


def keyword_filter(posts: DataFrame, word: str) -> DataFrame:
    return posts.filter(contains_word(F.col("text"), word))


def in_window(date: Column, first: str, last: str) -> Column:
    lo, hi = (F.lit(v).cast("timestamp_ntz") for v in (first, last))
    return date.isNull() | date.between(lo, hi)


def date_window(posts: DataFrame, first: str, last: str, computed: bool = False) -> DataFrame:
    """Keep rows without a date and rows with ``first <= date <= last``.

    On a stored date the predicate reaches the scan; set ``computed`` when the
    date is parsed in the same plan.
    """
    date = F.col("date")
    if computed:
        return posts.filter(once(date, lambda d: in_window(d, first, last)))
    return posts.filter(in_window(date, first, last))


def keyword_in_window(posts: DataFrame, word: str, first: str, last: str) -> DataFrame:
    return date_window(keyword_filter(posts, word), first, last)


def slice_equals(posts: DataFrame, **values) -> DataFrame:
    """Equality slice on any of the dimension columns."""
    return posts.filter(
        reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in values.items()], F.lit(True))
    )


def multiselect(posts: DataFrame, **selected: Sequence) -> DataFrame:
    """Membership per dimension; an empty selection does not filter."""
    parts = [F.col(k).isin(list(v)) for k, v in selected.items() if v]
    return posts.filter(reduce(lambda a, b: a & b, parts)) if parts else posts


def non_empty_topic(posts: DataFrame) -> DataFrame:
    return posts.filter(F.col("topic_label") != "")


def is_spike(growth: Column, last_count: Column, min_growth: float = 50, min_count: int = 5) -> Column:
    return F.coalesce((growth > min_growth) & (growth != 0) & (last_count >= min_count), F.lit(False))


def gap_significance(gap: Column, points: float = 2) -> Column:
    return (
        F.when(gap > points, F.lit("higher"))
        .when(gap < -points, F.lit("lower"))
        .otherwise(F.lit("similar"))
    )
