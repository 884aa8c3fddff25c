"""Landed sources that count only when they are whole.

Landing has two phases.  First the items of every brand are written, each by a Spark
job; then one small marker with the items per brand is committed.  Readers trust a
source only by its marker, so one that was half landed when its job died is not mixed
with the substitute: the whole source comes from one place or from the other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from voicetide.operators.normalise import NORMALISERS, tag_source
from voicetide.sources.paths import path_exists
from voicetide.sources.raw_json import raw_path, read_raw, write_raw

MARKER_SCHEMA = "brand string, n_items long"


def marker_path(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/_whole_{source}"


def withdraw(spark: SparkSession, root: str, source: str) -> None:
    """Take the marker away: the source is being landed again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(marker_path(root, source))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def land_source(items: Mapping[str, DataFrame], root: str, source: str) -> None:
    """Write the items of all brands (JSON Lines), then the marker."""
    spark = next(iter(items.values())).sparkSession
    withdraw(spark, root, source)
    counts = []
    for brand, rows in items.items():
        seen = Observation(f"{source}-{brand}")
        write_raw(
            rows.observe(seen, F.count(F.lit(1)).alias("n_items")), raw_path(root, brand, source)
        )
        counts.append((brand, seen.get["n_items"]))
    marker = spark.createDataFrame(counts, MARKER_SCHEMA).coalesce(1)
    marker.write.mode("overwrite").json(marker_path(root, source))


def whole(spark: SparkSession, root: str, source: str, brands: Sequence[str]) -> bool:
    """Whether the source was landed completely for these brands and has items."""
    path = marker_path(root, source)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return False
    landed = {r.brand: r.n_items for r in spark.read.schema(MARKER_SCHEMA).json(path).collect()}
    present = all(
        b in landed and path_exists(spark, raw_path(root, b, source)) for b in brands
    )
    return present and any(landed[b] for b in brands)


def posts_of(
    spark: SparkSession, real: str, substitute: str, source: str, brands: Sequence[str]
) -> DataFrame:
    """Posts of a source: the real items if they are whole, else all of the substitute's.

    ``data_source`` tells which; a substitute that is absent gives no rows.
    """
    is_whole = whole(spark, real, source, brands)
    root, tag = (real, "real") if is_whole else (substitute, "synthetic")
    items = read_raw(spark, root, brands, source, json_arrays=False)
    return tag_source(NORMALISERS[source](items), tag)
