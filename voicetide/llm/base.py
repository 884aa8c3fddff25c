"""What the operators share: text batches in Python tasks, row keys, written intermediates."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from voicetide.session import fresh_path

#: Rows and bytes handed to a batch function at once; bounds a worker's memory.
SLICE_ROWS = 1024
SLICE_BYTES = 4_000_000

#: The columns of ``documents``, which every stage of the pipeline but the last returns.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def text_col(name: str = "text") -> Column:
    """A text column as string, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_crc(name: str = "doc_id") -> Column:
    """crc32 of the id written as text; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def importable(spark: SparkSession) -> None:
    """Lets Python tasks import this package where it lies, as on a shared installation.

    A cluster without one gets the package by ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(rows: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    importable(rows.sparkSession)
    path = fresh_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def discard(rows: DataFrame) -> None:
    """Delete what ``written`` wrote, once no frame that is still to be computed reads it."""
    for file in rows.inputFiles()[:1]:
        path = rows.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(rows.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def tidy(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs.

    It does so once the driver's JVM has collected their plans, which a small driver
    heap brings about too late: a chain of written steps would hold all its shuffles.
    """
    spark.sparkContext._jvm.System.gc()


def hash_sample(rows: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """The rows with the smallest hashes of ``keys``, at most ``most``.

    A share of the hash range that surely holds enough rows is cut first, so the
    tasks together send little more than ``most`` rows, however many they are.
    """
    n = rows.count()
    share = min(1.0, (most + 8 * most**0.5 + 8) / max(n, 1))
    place = F.shiftrightunsigned(F.xxhash64(*keys), 11) / float(2**53)
    return rows.filter(place < share).orderBy(place, *keys).limit(most)


#: A key is hot beyond this many rows and beyond this share (one in ``HOT_KEYS``) of all rows.
HOT_ROWS = 10_000
HOT_KEYS = 10_000


def dealt_join(
    rows: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    counts: DataFrame,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``rows`` joined with ``side`` on ``keys``, rows of hot keys dealt over tasks.

    ``counts`` holds ``keys`` and the number of rows as ``_n`` (keys without others may be
    left out).  A hot key holds more than ``hot_rows`` and more than one in ``HOT_KEYS`` of
    the counted rows, so fewer than ``HOT_KEYS`` keys are broadcast.  Its rows are dealt by
    the hash of ``spread_by`` to parts of about that size, and its rows of ``side`` are
    copied to every part.  Null keys match nothing, as in any join, and stay with ``how="left"``.
    """
    total = counts.agg(F.sum("_n").alias("_all"))  # one row with one number
    most = F.greatest(F.col("_all") / HOT_KEYS, F.lit(hot_rows))
    hot = F.broadcast(
        counts.join(F.broadcast(total), F.lit(True))
        .filter(F.col("_n") > most)
        .select(*keys, F.ceil(F.col("_n") / most).cast("int").alias("_parts"))
    )
    part = F.pmod(F.xxhash64(*spread_by), F.coalesce("_parts", F.lit(1))).cast("int")
    left = rows.join(hot, [*keys], "left").withColumn("_part", part).drop("_parts")
    parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    right = side.join(hot, [*keys], "left").withColumn("_part", F.explode(parts)).drop("_parts")
    return left.join(right, [*keys, "_part"], how).drop("_part")


def free_name(rows: DataFrame, name: str) -> str:
    """A column name that ``rows`` does not have."""
    taken = {c.lower() for c in rows.columns}
    return name if name.lower() not in taken else f"{name}_{uuid.uuid4().hex}"


#: What a Python worker keeps while a task runs, such as caches of words.
_KEPT: dict[tuple, Any] = {}


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """The value under ``key``, made once a task: workers live longer than tasks, and one
    that kept the caches of every stage it has served would hold them all."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Drop what ``kept`` holds."""
    _KEPT.clear()


def slices(batch: pa.RecordBatch, sized: int) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of bounded rows and bytes of one text or list column.

    A text longer than the bound is a piece of its own: texts are never cut.
    """
    column = batch.column(sized)
    lists = pa.types.is_list(column.type)
    length = pc.multiply(pc.list_value_length(column), 8) if lists else pc.binary_length(column)
    sizes = pc.fill_null(length, 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = int(ends[start - 1]) if start else 0
        end = int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))
        end = max(start + 1, min(end, start + SLICE_ROWS))
        yield batch.slice(start, end - start)
        start = end


def add_columns(
    rows: DataFrame,
    make: Callable[..., tuple[Sequence[int] | None, Iterable[Sequence]]],
    added: T.StructType | str,
    inputs: Sequence[str],
    keep: Sequence[str],
) -> DataFrame:
    """``mapInArrow`` over bounded slices; the columns ``keep`` pass as Arrow arrays.

    ``make`` gets each input column of a slice as a list and returns the new
    columns, and with them the input row of each output row (None: one each, in
    order).  Slices are bounded by the bytes of the first input.
    """
    if isinstance(added, str):
        added = T.StructType.fromDDL(added)
    importable(rows.sparkSession)
    wanted = list(dict.fromkeys([*keep, *inputs]))
    source = rows.select(*wanted)
    schema = T.StructType([*source.select(*keep).schema.fields, *added.fields])
    arrow = to_arrow_schema(schema)
    at = [wanted.index(c) for c in inputs]
    passing = [wanted.index(c) for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        try:
            for batch in batches:
                for piece in slices(batch, at[0]):
                    parents, made = make(*[piece.column(i).to_pylist() for i in at])
                    passed = [piece.column(i) for i in passing]
                    if parents is not None:
                        index = pa.array(parents, pa.int64())
                        passed = [c.take(index) for c in passed]
                    columns = [
                        (c if isinstance(c, pa.Array) else pa.array(c, f.type)).cast(f.type)
                        for c, f in zip([*passed, *made], arrow, strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        finally:
            forget()

    return source.mapInArrow(run, schema)
