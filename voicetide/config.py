"""Configuration objects: taxonomy, calendar, focus rule.

All of them are small, driver-side values that become literals in the plan.
Nothing here depends on a clock or on data.
"""

from __future__ import annotations

import calendar as _cal
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voicetide.functions.literals import literal_table, lookup


@dataclass(frozen=True)
class Bucket:
    key: str
    label: str
    patterns: tuple[str, ...] = ()


@dataclass(frozen=True)
class Taxonomy:
    """Ordered buckets plus the default bucket that takes everything else."""

    buckets: tuple[Bucket, ...]
    default: Bucket

    @property
    def all_buckets(self) -> tuple[Bucket, ...]:
        return (*self.buckets, self.default)

    @property
    def keys(self) -> list[str]:
        return [b.key for b in self.all_buckets]

    @property
    def labels(self) -> list[str]:
        return [b.label for b in self.all_buckets]

    def label_of(self, key: Column) -> Column:
        """Label of a bucket key; null for an unknown key."""
        return lookup(key, {b.key: b.label for b in self.all_buckets})

    def order_of(self, key: Column) -> Column:
        """Position of a bucket key, the default bucket last."""
        return lookup(key, {b.key: i for i, b in enumerate(self.all_buckets)})

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [
            (b.key, b.label, i, "|".join(b.patterns) or None)
            for i, b in enumerate(self.all_buckets)
        ]
        return literal_table(
            spark, rows, "bucket string, bucket_label string, bucket_ord int, pattern string"
        )

    @classmethod
    def from_df(cls, dim: DataFrame) -> Taxonomy:
        """Read a taxonomy dimension; the row without a pattern is the default.

        A taxonomy is configuration: its patterns are compiled into the plan.
        Dimensions that grow with the data are joined (``operators.joins``).
        """
        rows = dim.orderBy("bucket_ord").collect()
        matched = [r for r in rows if r["pattern"]]
        default = [r for r in rows if not r["pattern"]]
        if len(default) != 1:
            raise ValueError("a taxonomy needs exactly one row without a pattern")
        return cls(
            tuple(Bucket(r["bucket"], r["bucket_label"], (r["pattern"],)) for r in matched),
            Bucket(default[0]["bucket"], default[0]["bucket_label"]),
        )


@dataclass(frozen=True)
class Period:
    year: int
    month_num: int

    @property
    def month(self) -> str:
        return _cal.month_name[self.month_num]

    @property
    def code(self) -> int:
        return self.year * 100 + self.month_num


@dataclass(frozen=True)
class Calendar:
    """Ordered reporting months; "previous" means previous in this list."""

    periods: tuple[Period, ...]

    @classmethod
    def of(cls, year: int, months: Iterable[int]) -> Calendar:
        return cls(tuple(Period(year, m) for m in months))

    @property
    def names(self) -> list[str]:
        """Month names; with the year where the calendar repeats a name."""
        names = [p.month for p in self.periods]
        return [
            f"{n} {p.year}" if names.count(n) > 1 else n
            for n, p in zip(names, self.periods, strict=True)
        ]

    def __len__(self) -> int:
        return len(self.periods)

    def index_of(self, date: Column) -> Column:
        """0-based position of the date's month; null outside the calendar."""
        code = F.year(date) * 100 + F.month(date)
        return lookup(code, {p.code: i for i, p in enumerate(self.periods)})

    def name_of(self, index: Column) -> Column:
        return lookup(index, dict(enumerate(self.names)))

    def covers(self, date: Column) -> Column:
        """Range predicate over the whole calendar, so the scan can prune on it."""
        codes = sorted(p.code for p in self.periods)
        first, last = codes[0], codes[-1]
        end_year, end_month = divmod(last, 100)
        end_year, end_month = (end_year + 1, 1) if end_month == 12 else (end_year, end_month + 1)
        lo = F.lit(f"{first // 100:04d}-{first % 100:02d}-01").cast("timestamp_ntz")
        hi = F.lit(f"{end_year:04d}-{end_month:02d}-01").cast("timestamp_ntz")
        return (date >= lo) & (date < hi)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(p.year, p.month, p.month_num, i) for i, p in enumerate(self.periods)]
        return literal_table(spark, rows, "year int, month string, month_num int, month_idx int")


@dataclass(frozen=True)
class FocusRule:
    """Keep posts naming ``keyword``; drop those about an excluded vertical
    unless a rescue word is present too."""

    keyword: str
    excluded: Sequence[str] = ()
    rescue: Sequence[str] = ()
