"""The exact most frequent labels where labels are too many to group them all.

Every task keeps a frequent-items sketch of bounded size, the sketches are merged, and
only their candidates are counted exactly: a group per candidate leaves a task instead
of a group per label.  The sketch misses no label above its error bound, so the result
is exact if the k-th candidate is above it.  Where it is not, as with flat counts, all
labels are counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labels a sketch tracks, which bounds its size and its error.
TRACKED = 100_000
#: Labels that are counted exactly, as a multiple of k.
CANDIDATES_PER_K = 20


@dataclass
class Candidates:
    """``labels`` and the largest count that any other label can have."""

    labels: list[str]
    bound: float

    def filter(self, label: Column) -> Column:
        return label.isin(self.labels) if self.labels else F.lit(False)


def candidates(rows: DataFrame, label: str, most: int, tracked: int = TRACKED) -> Candidates:
    """At most ``most`` labels by estimated count; null labels do not count.

    A sketch with a table of M cells errs by 3.5 / M of all rows at most, merged ones too.
    Labels without a place in its list have twice that at most, or, in a full list, no
    more than the least estimate in it (estimates never fall short).
    """
    most = min(most, tracked)
    # to a text that the sketch takes for any type of label
    named = rows.select(F.col(label).cast("string").alias("_label")).filter("_label IS NOT NULL")
    row = named.agg(
        F.expr(f"approx_top_k(_label, {most}, {tracked})").alias("found"), F.count(F.lit(1)).alias("n")
    ).first()
    found = row.found or []
    cells = 1 << (int(tracked / 0.75) - 1).bit_length() - 1  # a power of two, rather too small
    bound = 2 * 3.5 / cells * row.n
    if len(found) >= most:
        bound = max(bound, min(f["count"] for f in found))
    return Candidates([f["item"] for f in found], bound)


def settled(counts: list[int], k: int, bound: float) -> bool:
    """Whether no other label can be among the first k, given the candidates' exact counts."""
    best = sorted(counts, reverse=True)[:k]
    return bound < 1 if len(best) < k else best[-1] > bound


def top_labels(
    rows: DataFrame, label: str, k: int, tracked: int = TRACKED, per_k: int = CANDIDATES_PER_K
) -> DataFrame:
    """(label, n): the k most frequent labels, ties by label; exact."""

    def counted(some: DataFrame) -> DataFrame:
        total = some.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
        return total.orderBy(F.desc("n"), label).limit(k)

    known = rows.filter(F.col(label).isNotNull())
    some = candidates(known, label, k * per_k, tracked)
    best = counted(known.filter(some.filter(F.col(label).cast("string"))))
    if settled([r.n for r in best.select("n").collect()], k, some.bound):
        return best
    return counted(known)
