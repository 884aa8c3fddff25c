"""Landed JSON items, one location per (brand, source)."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voicetide.operators.unions import union_all
from voicetide.schema import RAW_SOURCES
from voicetide.sources.json_arrays import array_records
from voicetide.sources.paths import empty_frame, path_exists

log = logging.getLogger(__name__)

#: The column that holds the text of a record that is not JSON.
BROKEN = "_broken_record"
#: The column that holds the file of a record out of an array.
FILE = "_record_file"


def raw_path(root: str, brand: str, source: str) -> str:
    return f"{root.rstrip('/')}/{brand}_{source}.json"


def read_raw(
    spark: SparkSession,
    root: str,
    brands: Sequence[str],
    source: str,
    json_arrays: bool = True,
    quarantine: str | None = None,
) -> DataFrame:
    """Items of one source for several brands, with a ``brand`` column.

    ``json_arrays=True`` reads one JSON array per file, cut at record boundaries
    (``json_arrays``) and copied to the shared folder first; ``False`` reads JSON
    Lines.  Both split.  A path may be a file or a folder of files.  Missing paths
    give no rows.

    A record that is not JSON fails the read.  With ``quarantine`` such records
    are written below that path instead, with the file they came from.
    """
    _, schema = RAW_SOURCES[source]
    options = {"mode": "FAILFAST"}
    if quarantine is not None:
        schema = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    frames = []
    for brand in brands:
        path = raw_path(root, brand, source)
        if path_exists(spark, path):
            if json_arrays:
                items = parsed(array_records(spark, path), schema, options)
            else:
                items = spark.read.schema(schema).options(**options).json(path)
            if quarantine is not None:
                items = set_aside(items, f"{quarantine.rstrip('/')}/{brand}_{source}")
            # A constant brand lets Spark drop the other brands' filter rules.
            frames.append(items.drop(FILE).withColumn("brand", F.lit(brand)))
        else:
            log.warning("no landed data at %s", path)
    if not frames:
        return empty_frame(spark, schema).withColumn("brand", F.lit(""))
    return union_all(frames)


def parsed(records: DataFrame, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The fields of JSON texts, with ``FILE``.

    The generator keeps Spark from parsing a text again for a filter on a field.
    """
    return records.select(F.inline_outer(F.array(F.from_json("record", schema, options))), F.col("file").alias(FILE))


def set_aside(items: DataFrame, path: str) -> DataFrame:
    """Write the broken records to ``path`` and return the others."""
    broken = F.col(BROKEN).isNotNull()
    held = items.filter(broken).select(
        F.col(BROKEN).alias("record"),
        F.col(FILE).alias("file") if FILE in items.columns else F.input_file_name().alias("file"),
        # Spark asks for a parsed field beside the record's text
        F.try_variant_get(F.col("id"), "$", "string").alias("id"),
    )
    held.write.mode("overwrite").json(path)
    return items.filter(~broken).drop(BROKEN)


def write_raw(
    items: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str = "gzip"
) -> None:
    """Write items as JSON Lines, optionally partitioned (brand, platform).

    Items repeat their field names, so compressed they take about a third.  A
    compressed file is read by one task; files are no larger than what one task
    writes, so many tasks read a folder.
    """
    writer = items.write.mode("overwrite").option("compression", compression)
    writer = writer.option("zlib.compress.level", "BEST_SPEED")  # a tenth larger, in a third of the time
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)
