"""Keep-first deduplication across batches without reading old posts.

The index holds what is needed of the posts kept so far: a digest per key, by parts, and
a filter of 64-bit words in which every key has set four bits of one word.  A new batch
meets the filter first; only keys whose bits are all set may be old, and only these are
looked up among the digests.  Both are joins on narrow rows, spread by hash.

A batch's posts are shuffled once, by digest, for both steps, and written once.

Every batch has folders of its own, which a rerun replaces, and sees earlier batches only,
so a batch that is run again gives the same rows.  Kept is the first of a key in its
batch; a post of an earlier batch always goes before those of later ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voicetide.session import materialise
from voicetide.sources.paths import path_exists

#: Words of the filter.  More keys than about four a word make it less sharp, never wrong.
WORDS = 1 << 22
#: Parts of the digests; a batch's candidates prune those it does not need.
PARTS = 64
BITS_PER_KEY = 4

KEYS_SCHEMA = "digest string, batch long, part int"
FILTER_SCHEMA = "word long, bits long, batch long"


def digest(keys: Sequence[Column]) -> Column:
    """SHA-256 of the keys, null and empty apart."""
    named = F.struct(*[k.cast("string").alias(f"k{i}") for i, k in enumerate(keys)])
    return F.sha2(F.to_json(named, {"ignoreNullFields": "false"}), 256)


def _number(at: int, digits: int) -> Column:
    """A piece of the digest as a number."""
    return F.conv(F.substring("digest", at, digits), 16, 10).cast("long")


def word(words: int) -> Column:
    return F.pmod(_number(1, 15), F.lit(words))


def mask() -> Column:
    """The bits of a key in its word."""
    bits = F.lit(0).cast("long")
    for i in range(BITS_PER_KEY):
        place = F.pmod(_number(17 + 4 * i, 4), F.lit(64)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return bits


def part() -> Column:
    return F.pmod(_number(40, 8), F.lit(PARTS)).cast("int")


def _read(spark: SparkSession, path: str, schema: str, batch: int) -> DataFrame:
    """What earlier batches stored."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).filter(F.col("batch") < batch)


def perhaps_known(
    digests: DataFrame, path: str, batch: int, words: int = WORDS
) -> DataFrame:
    """The digests whose bits an earlier batch has all set: every old one, few others."""
    stored = _read(digests.sparkSession, f"{path}/filter", FILTER_SCHEMA, batch)
    asked = digests.select("digest", word(words).alias("word"), mask().alias("_mask"))
    hits = asked.join(stored, "word").filter(F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask"))
    return hits.select("digest").distinct()


def known(digests: DataFrame, path: str, batch: int, words: int = WORDS) -> DataFrame:
    """The digests of keys that an earlier batch has kept."""
    some = perhaps_known(digests, path, batch, words).withColumn("part", part())
    stored = _read(digests.sparkSession, f"{path}/keys", KEYS_SCHEMA, batch)
    return some.join(stored, ["part", "digest"], "left_semi").select("digest")


def keep_new(
    rows: DataFrame,
    keys: Sequence[Column],
    order: Sequence[Column],
    path: str,
    batch: int,
    words: int = WORDS,
) -> DataFrame:
    """The first row of every key that no earlier batch has; adds their keys to the index.

    Batches are numbered in the order in which they count and run one after the other.
    ``words`` is the same for all batches of an index.  ``rows`` are read twice, first
    the keys alone: rows that are costly to make should be stored before.
    """
    path = path.rstrip("/")
    named = rows.withColumn("digest", digest(keys))
    # as in ``keep_first``, later copies go inside the map tasks; the digest alone deals
    # the rows, so the join with the old ones finds them in place
    place = F.row_number().over(Window.partitionBy("digest").orderBy(*order))
    new = named.withColumn("_rn", place).filter(F.col("_rn") == 1).drop("_rn")
    if path_exists(rows.sparkSession, f"{path}/filter"):
        new = new.join(known(named.select("digest").distinct(), path, batch, words), "digest", "left_anti")
    new = materialise(new, "batch-new")
    added = new.select("digest")
    (
        added.withColumn("part", part()).hint("rebalance", "part")
        .write.mode("overwrite").partitionBy("part").parquet(f"{path}/keys/batch={batch}")
    )
    # the filter goes last: without it the digests would not be asked
    (
        added.groupBy(word(words).alias("word")).agg(F.bit_or(mask()).alias("bits"))
        .write.mode("overwrite").parquet(f"{path}/filter/batch={batch}")
    )
    return new.drop("digest")
