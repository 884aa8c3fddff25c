"""Session settings the library relies on."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: str = "*", app: str = "voicetide", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                       **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The shared folder for written intermediates.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset, a
    folder below the warehouse serves, which all executors reach as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediates"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused, so retries are safe.

    Returned frames read these folders lazily, so they live as long as the
    application: ``release`` drops them all when its results are stored.
    """
    return f"{shared_folder(spark).rstrip('/')}/{_home(spark)}/{name}-{uuid.uuid4().hex}"


def importable(spark: SparkSession) -> None:
    """Lets Python tasks import this package where it lies, as on a shared installation.

    A cluster without one gets the package by ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def materialise(rows: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write to the shared folder and read back: survives lost executors.

    A partitioned write is rebalanced, so that neither one task nor a file per task
    and partition results from a partition that holds most rows.
    """
    path = fresh_path(rows.sparkSession, name)
    if partition_by:
        rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
    else:
        rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete every written intermediate of this library in the shared folder.

    Call it when no frame made before is read any more.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/{_home(spark)}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _home(spark: SparkSession) -> str:
    return f"voicetide-{spark.sparkContext.applicationId}"
