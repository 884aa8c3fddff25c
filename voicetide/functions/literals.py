"""Small constant tables and lookups that live inside the plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lookup(key: Column, mapping: Mapping[Any, Any]) -> Column:
    """Value of ``key`` in a constant map, null when absent."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.create_map(*pairs)[key]


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A constant table built on the JVM (no Python worker, no upload)."""
    fields = T.StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
        for row in rows
    ]
    one = spark.range(0, 1, 1, 1)
    if not structs:
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
        return one.limit(0).select(*nulls)
    return one.select(F.inline(F.array(*structs)))


def grid(spark: SparkSession, **axes: Sequence[Any]) -> DataFrame:
    """Every combination of a few constant lists (sizes fixed by arguments)."""
    out = spark.range(0, 1, 1, 1)
    for name, values in axes.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out.drop("id")
