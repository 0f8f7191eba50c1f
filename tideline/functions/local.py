"""Small frames made on the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def small_frame(
    spark: SparkSession, rows: Sequence[Mapping[str, object]], schema: T.StructType
) -> DataFrame:
    """A few rows of metadata as a DataFrame; columns a row lacks are null.

    They go over as one Arrow batch and become a local relation. A list of tuples
    would start a Python worker in every task that reads it, and an empty one would
    hide from the optimizer that it is empty.
    """
    table = pa.Table.from_pylist([dict(row) for row in rows], schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema=schema)


def nullable(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed everywhere, as rows read back from files have it."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType))
    return kind
