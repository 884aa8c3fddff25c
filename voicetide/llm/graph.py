"""Connected components of a link table, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voicetide.llm.base import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every linked node with the smallest node it reaches.

    Alternating large and small stars: each round hangs neighbours below the
    smallest one, until every node hangs below its component's smallest.  The
    number of rounds grows with the logarithm of the size.  Minima are
    aggregated before the shuffle and each round is written, so neither a node
    with very many links nor a lost executor is a problem.  Null ends are left
    out; a graph without links gives an empty result.
    """
    up = (
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    state = None
    while True:
        up = written(_small_star(_large_star(up)), "stars")
        seen = up.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(seen) == state:
            return up.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                up.select("v", "v").distinct()
            )
        state = tuple(seen)


def _large_star(up: DataFrame) -> DataFrame:
    """Every larger neighbour of a node hangs below the node's smallest neighbour."""
    both = up.union(up.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
    return (
        both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(up: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, hang below the smallest."""
    least = up.groupBy("u").agg(F.min("v").alias("m"))
    moved = up.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", "m")).distinct()
