"""Ranking inside groups, built so that a hot group never meets one task.

A rank filter lets Spark cut every map task's output to ``n`` rows per group
before the shuffle.  With very many map tasks a hot group would still send
``n`` rows from each of them to one reducer, so the cut is made twice: first
per (group, salt), the salt being the map partition, then per group over at
most ``n * SALTS`` rows.  The result does not depend on the salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64
#: Parts per group and per wanted row in ``above_floor``, and the least number of parts.
PARTS_PER_ROW = 4
MIN_PARTS = 256
#: Rows from which a group has a floor: at most one floor per so many rows is broadcast.
LARGE_GROUP = 4096


def top_n(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rn",
    salts: int = SALTS,
) -> DataFrame:
    """First ``n`` rows of each group; ``order`` must be a total order."""
    if salts > 1:
        salted = rows.withColumn("_salt", F.spark_partition_id() % salts)
        first = Window.partitionBy(*keys, "_salt").orderBy(*order)
        rows = (
            salted.withColumn("_rn", F.row_number().over(first))
            .filter(F.col("_rn") <= n)
            .drop("_rn", "_salt")
        )
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def above_floor(
    rows: DataFrame, keys: Sequence[str], value: str, row_key: str, n: int
) -> DataFrame:
    """Rows that can be among the ``n`` largest of their group, by hash aggregation only.

    Rows fall into parts per group by a hash of their key, several for each
    wanted row.  The parts' maxima belong to different rows, so the n-th largest
    of them is a floor that at least ``n`` rows reach.  Only a group of fewer than
    ``LARGE_GROUP`` rows, or of too few to fill ``n`` parts, has no floor and keeps
    all of them.

    Floors are so few that they are broadcast: joined by a shuffle, the whole
    rows of a hot group would meet in one task.
    """
    parts = max(MIN_PARTS, PARTS_PER_ROW * n)
    maxima = rows.groupBy(*keys, F.pmod(F.xxhash64(row_key), F.lit(parts)).alias("_part")).agg(
        F.max(value).alias("_floor"), F.count(F.lit(1)).alias("_n")
    )
    group = Window.partitionBy(*keys)
    floors = (
        maxima.withColumn("_rows", F.sum("_n").over(group))
        .withColumn("_rn", F.row_number().over(group.orderBy(F.desc("_floor"))))
        .filter((F.col("_rn") == n) & (F.col("_rows") >= LARGE_GROUP))
        .select(*keys, "_floor")
    )
    reached = F.col("_floor").isNull() | (F.col(value) >= F.col("_floor"))
    return rows.join(F.broadcast(floors), list(keys), "left").filter(reached).drop("_floor")


def top_posts(
    posts: DataFrame,
    n: int = 8,
    keys: Sequence[str] = ("brand", "bucket"),
    columns: Sequence[str] = ("id", "text", "platform", "date", "engagement", "sentiment", "url"),
) -> DataFrame:
    """Most engaging posts per group, ties by id.

    Few wide rows are sorted: a narrow pass finds each large group's floor, and only
    the posts that reach it are ranked.  Those cut to ``n`` per group and map task are
    all that is shuffled.
    """
    wanted = list(dict.fromkeys([*keys, *columns]))
    rows = above_floor(posts.select(*wanted), keys, "engagement", "id", n)
    return top_n(
        rows.select(*wanted), keys, [F.col("engagement").desc(), F.col("id").asc()], n
    )


def preview(posts: DataFrame, n: int = 500) -> DataFrame:
    """First rows by date and id (a display feature)."""
    return posts.orderBy(F.col("date").asc_nulls_last(), "id").limit(n)


def shuffle_place(key: str = "id", seed: int = 42) -> Column:
    """What a seeded order sorts by: a digest any engine has."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"/{seed}")).cast("binary"))


def seeded_shuffle(posts: DataFrame, key: str = "id", seed: int = 42) -> DataFrame:
    """A random-looking order that is the same for any partitioning."""
    return posts.orderBy(shuffle_place(key, seed), key)
