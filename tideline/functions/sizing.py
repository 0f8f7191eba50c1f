"""Measured sizes, for decisions that are only right for small inputs."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.session import scratch_path

# The most a broadcast may take, in estimated bytes of its rows. Every executor
# holds one copy, and the hashed form takes about twice this.
BROADCAST_BYTES = 64 * 1024 * 1024


def _element_bytes(kind: T.DataType) -> int:
    """What one value is taken to need inside a nested column; texts count as 32 bytes there."""
    if isinstance(kind, T.StructType):
        return 8 + sum(8 + _element_bytes(field.dataType) for field in kind.fields)
    return 32 if isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType)) else 8


def row_bytes(schema: T.StructType) -> Column:
    """Estimated bytes of a row: eight per field plus the text and nested parts."""
    width = F.lit(16 + 8 * len(schema.fields)).cast("long")
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            part = F.octet_length(column)
        elif isinstance(field.dataType, T.ArrayType):
            part = _element_bytes(field.dataType.elementType) * F.size(column)
        elif isinstance(field.dataType, T.MapType):
            kinds = (field.dataType.keyType, field.dataType.valueType)
            part = sum(map(_element_bytes, kinds)) * F.size(column)
        elif isinstance(field.dataType, T.StructType):
            part = F.lit(_element_bytes(field.dataType))
        else:
            continue
        width = width + F.coalesce(part, F.lit(0))
    return width


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back.

    Used where a result feeds several jobs, or must not change when the table it
    came from does. The files outlive any executor, so a lost one costs a re-read
    and not the lineage behind it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_measured(
    df: DataFrame, label: str, **metrics: Column
) -> tuple[DataFrame, dict[str, Any]]:
    """``materialize`` with aggregates over the rows, taken while they are written.

    ``bytes`` is always among them; it is null when there are no rows.
    """
    seen = Observation()
    measures = {"bytes": F.sum(row_bytes(df.schema)), **metrics}
    named = [measure.alias(name) for name, measure in measures.items()]
    written = materialize(df.observe(seen, *named), label)
    return written, seen.get
