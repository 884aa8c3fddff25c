"""Path checks through the Hadoop file system, so any store works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(jvm_path)


def empty_frame(spark: SparkSession, schema) -> "DataFrame":  # noqa: F821
    """A typed empty frame."""
    return spark.createDataFrame(spark.sparkContext.emptyRDD(), schema)
