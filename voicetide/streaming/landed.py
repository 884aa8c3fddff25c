"""Newly landed JSON items to the post table and the report cube, exactly once.

Each trigger reads only the files that arrived since the last one, of all brands of
a source in one stream.  Every batch is written below its own number, so a batch that
is run again after a failure replaces what it had written: the table and the cube are
the same as after one run without failures.

Repeated posts are dropped while the stream may still see their first copy
(``distinct_posts``).  Deduplication over all time is a batch step on the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voicetide.config import Calendar
from voicetide.operators.cube import feedback_cube, roll_up
from voicetide.operators.dedup import PREFIX_LENGTH
from voicetide.operators.normalise import NORMALISERS, add_month_columns, tag_source
from voicetide.schema import RAW_SOURCES

#: The dimensions of the cube that all reports derive from.
CUBE_KEYS = ("brand", "platform", "bucket", "month_idx")


def landed_items(
    spark: SparkSession, folder: str, source: str, brand: str, max_files: int = 1000
) -> DataFrame:
    """Stream of the JSON Lines files of one brand and source."""
    _, schema = RAW_SOURCES[source]
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return stream.json(folder).withColumn("brand", F.lit(brand))


def landed_brands(spark: SparkSession, root: str, source: str, max_files: int = 1000) -> DataFrame:
    """Stream of the JSON Lines files of one source of all brands below ``root``.

    The brand is the name of the landed folder or file before the source's.
    """
    _, schema = RAW_SOURCES[source]
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    items = stream.json(f"{root.rstrip('/')}/*_{source}.json")
    brand = F.regexp_extract(F.col("_metadata.file_path"), rf"/([^/]*)_{source}\.json", 1)
    return items.withColumn("brand", F.url_decode(brand))


def landed_posts(items: DataFrame, source: str) -> DataFrame:
    return tag_source(add_month_columns(NORMALISERS[source](items)), "real")


def distinct_posts(
    posts: DataFrame, delay: str = "30 days", scope: Sequence[str] = ("brand", "platform"), length: int = PREFIX_LENGTH
) -> DataFrame:
    """Posts without later copies of the same scope and leading text.

    State is a hash per post, kept until the newest date seen is ``delay`` past the
    post's.  A post that comes later than that can't be compared any more and would be
    dropped, so ``delay`` is to cover the lateness of a source.  Posts without a date
    have no place in this order; they go round the state and all stay, for the batch
    deduplication to judge.
    """
    key = F.md5(F.concat_ws("\x01", *scope, F.substring("text", 1, length)).cast("binary"))
    dated = posts.filter(F.col("date").isNotNull()).withColumn("_key", key)
    # event time is an instant; the post's date stays as it is
    timed = dated.withColumn("_at", F.col("date").cast("timestamp")).withWatermark("_at", delay)
    first = timed.dropDuplicatesWithinWatermark(["_key"]).drop("_key", "_at")
    return first.unionByName(posts.filter(F.col("date").isNull()))


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """AQE while a batch is written.

    A stream with state is planned without it.  A batch of such a stream comes as an RDD
    of the planned stream, so this concerns only what follows; the next batch is planned
    as before.
    """
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def write_batch(posts: DataFrame, batch: int, table: str, cube: str | None = None, calendar: Calendar | None = None) -> None:
    """One batch of posts below its number, and its share of the cube.

    Rebalanced by AQE, so neither a file per task and month nor one task for the brand
    that holds most posts.  Written in place of an earlier attempt.
    """
    path = f"{table.rstrip('/')}/batch={batch}"
    with adaptive(posts.sparkSession):
        posts.hint("rebalance", "brand", "month").write.mode("overwrite").partitionBy("brand", "month").parquet(path)
        if cube is not None:
            stored = posts.sparkSession.read.schema(posts.schema).parquet(path)
            share = feedback_cube(stored, CUBE_KEYS, calendar)
            share.coalesce(1).write.mode("overwrite").parquet(f"{cube.rstrip('/')}/batch={batch}")


def start_ingest(
    items: DataFrame,
    source: str,
    table: str,
    checkpoint: str,
    enrich: Callable[[DataFrame], DataFrame] = lambda posts: posts,
    delay: str | None = None,
    cube: str | None = None,
    calendar: Calendar | None = None,
) -> StreamingQuery:
    """Append everything that has landed so far, then stop.

    ``enrich`` is any row-wise step, such as the focus filter or the classifier.
    With ``delay``, copies within it are dropped.  With ``cube``, each batch adds its
    share of the report cube there, so reports need not read the posts.
    """
    posts = landed_posts(items, source)
    posts = enrich(posts if delay is None else distinct_posts(posts, delay))
    return (
        posts.writeStream.foreachBatch(lambda rows, batch: write_batch(rows, batch, table, cube, calendar))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ingested(spark: SparkSession, table: str) -> DataFrame:
    """The posts of all batches."""
    return spark.read.option("basePath", table).parquet(table).drop("batch")


def read_cube(spark: SparkSession, cube: str) -> DataFrame:
    """The cube over all batches: their shares added up."""
    return roll_up(spark.read.option("basePath", cube).parquet(cube), *CUBE_KEYS)
