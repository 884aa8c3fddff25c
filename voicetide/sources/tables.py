"""Post tables as Parquet or CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voicetide.functions.timestamps import coerce_timestamp
from voicetide.schema import CLASSIFIED
from voicetide.sources.paths import empty_frame, path_exists


def write_parquet(posts: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a post table.

    A partitioned write is rebalanced first: AQE splits a hot partition over
    several tasks and merges small ones, so neither one task nor thousands of
    tiny files result from a brand that holds most rows.
    """
    if partition_by:
        posts = posts.hint("rebalance", *partition_by)
        posts.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        posts.write.mode("overwrite").parquet(path)


def write_classified(posts: DataFrame, path: str) -> None:
    write_parquet(posts, path, partition_by=("brand", "month"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_batches(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Batches stored apart as one table: one scan over all existing paths, not a union of scans.

    Columns are those of all batches together; a batch without a column has nulls.
    """
    found = [p for p in paths if path_exists(spark, p)]
    if not found:
        return empty_frame(spark, CLASSIFIED)
    return spark.read.option("mergeSchema", True).parquet(*found)


def write_csv(posts: DataFrame, path: str) -> None:
    """CSV with a header; quotes inside text are doubled, empty text stays empty."""
    (
        posts.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType = CLASSIFIED) -> DataFrame:
    """Read a post CSV by its header.  Texts hold line breaks, so records span lines.

    Columns are taken by name, in any order; absent ones are null and others are
    left out.  A header without any known column is an error, and so are files
    whose headers differ.  Bad dates and numbers become null, ``12.0`` counts as
    12.  The null marker is a character no text holds, so that a quoted empty
    string stays a string.
    """
    reader = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        .option("emptyValue", "").option("nullValue", "\x01").option("mode", "FAILFAST")
    )
    header = reader.csv(path).schema
    if not header.fields:
        return empty_frame(spark, schema)
    known = [f.name for f in schema.fields if f.name in header.names]
    if not known:
        raise ValueError(f"{path}: no known column among {header.names}")
    rows = reader.schema(header).option("enforceSchema", False).csv(path)

    def value(field: T.StructField) -> Column:
        if field.name not in known:
            return F.lit(None).cast(field.dataType).alias(field.name)
        column = rows[f"`{field.name}`"]
        if field.name == "date":
            typed = coerce_timestamp(column)
        elif isinstance(field.dataType, (T.LongType, T.IntegerType)):
            kind = field.dataType.simpleString()
            typed = F.coalesce(column.try_cast(kind), column.try_cast("double").try_cast(kind))
        else:
            typed = column.try_cast(field.dataType)
        return typed.alias(field.name)

    return rows.select(*[value(f) for f in schema.fields])


def read_posts(spark: SparkSession, parquet_path: str, csv_path: str | None = None) -> DataFrame:
    """Parquet if it is there, else CSV, else an empty post table."""
    if path_exists(spark, parquet_path):
        return read_parquet(spark, parquet_path)
    if csv_path and path_exists(spark, csv_path):
        return read_csv(spark, csv_path)
    return empty_frame(spark, CLASSIFIED)
