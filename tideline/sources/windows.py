"""Reads bounded by time windows, batches or months."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.sizing import BROADCAST_BYTES, materialize_measured, row_bytes


def _bound(df: DataFrame, ts_col: str, value: object) -> Column:
    """``value`` as a literal of the column's own type.

    It goes through text: a datetime literal would be shifted by the zone of the
    driver, and a cast on the column's side would keep the filter off the scan.
    """
    return F.lit(str(value)).cast(df.schema[ts_col].dataType)


def window_read(df: DataFrame, ts_col: str, start: object, end: object) -> DataFrame:
    """Rows with ``start <= ts < end``.

    Windows whose start is the end of the one before tile the source: each row is
    read by exactly one of them.
    """
    ts = F.col(ts_col)
    return df.where((ts >= _bound(df, ts_col, start)) & (ts < _bound(df, ts_col, end)))


class Span(NamedTuple):
    """What is known of a set of windows: its time range, the bytes of its rows, and how long they are
    on average."""

    first: object
    last: object
    bytes: int
    length: timedelta | None = None

    @staticmethod
    def measures(schema: T.StructType) -> dict[str, Column]:
        return {
            "first": F.min("window_start").cast("string"),
            "last": F.max("window_end").cast("string"),
            "bytes": F.sum(row_bytes(schema)),
            "length": F.avg(F.col("window_end") - F.col("window_start")),
        }


def due_window_read(
    df: DataFrame,
    windows: DataFrame,
    key: str,
    ts_col: str,
    span: Span | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every package's due window of a shared source, in one pass over it.

    ``windows`` has ``control_id``, ``window_start``, ``window_end`` and any other
    columns to carry along; ``key`` is the source column that holds the control
    id. Without a ``span`` the windows are written once and measured on the way.
    Their earliest start and latest end go to the scan as literals, which prunes
    files and row groups. Within ``limit`` the windows are broadcast, so the source
    is not shuffled; above it both sides meet by key and time bin (``_in_bins``), which spreads the
    rows of a hot package over the bins of its window.
    """
    taken = (set(df.columns) & set(windows.columns)) - ({"control_id"} if key == "control_id" else set())
    if taken:
        raise ValueError(f"rename the source columns {sorted(taken)}: batches carry these names")
    if span is None:
        windows, seen = materialize_measured(windows, "windows", **Span.measures(windows.schema))
        span = Span(seen["first"], seen["last"], seen["bytes"] or 0, seen["length"])
    if span.first is None:
        bounded = df.where(F.lit(False))
    else:
        bounded = window_read(df, ts_col, span.first, span.last)
    carried = [F.col(f"due.{name}") for name in windows.columns if name != key]
    if span.bytes <= limit or span.first is None:
        source, due, matches = bounded.alias("source"), F.broadcast(windows).alias("due"), F.lit(True)
    else:
        source, due = (side.alias(name) for side, name in zip(_in_bins(bounded, windows, ts_col, span), ("source", "due")))
        matches = F.col("source._bin") == F.col("due._bin")
    ts = F.col(f"source.{ts_col}")
    matches = (
        matches
        & (F.col(f"source.{key}") == F.col("due.control_id"))
        & (ts >= F.col("due.window_start"))
        & (ts < F.col("due.window_end"))
    )
    return source.join(due, matches, "inner").select(
        *[F.col(f"source.{name}") for name in df.columns], *carried
    )


# The most bins that a set of windows is cut into: no window gets more rows than that.
BINS = 4096


def _in_bins(df: DataFrame, windows: DataFrame, ts_col: str, span: Span) -> tuple[DataFrame, DataFrame]:
    """Both sides with the number of a time bin: a row's own, and a row for each bin that a window reaches.

    Bins are about as wide as the windows are long, so a window is in two or three of them.
    """
    kind = df.schema[ts_col].dataType
    kind = T.TimestampNTZType() if isinstance(kind, T.DateType) else kind
    whole = datetime.fromisoformat(str(span.last)) - datetime.fromisoformat(str(span.first))
    width = max(span.length or whole, whole / BINS, timedelta(seconds=1))
    first = F.lit(str(span.first)).cast(kind)

    def number(ts: Column) -> Column:
        # The difference of two times of one type is exact; dividing it by the width rounds down.
        return F.call_function("div", ts.cast(kind) - first, F.lit(width))

    last = F.greatest(F.col("window_end") - F.expr("interval 1 microsecond"), F.col("window_start"))
    bins = F.sequence(number(F.col("window_start")), number(last))
    return df.withColumn("_bin", number(F.col(ts_col))), windows.withColumn("_bin", F.explode(bins))


def staged_batch_read(
    raw: DataFrame, done: DataFrame, on: Sequence[str] = ("control_id", "window_start")
) -> DataFrame:
    """Raw rows of the batches listed in ``done``.

    A batch that was landed but never logged as completed is left out. The join is
    not hinted: Spark broadcasts ``done`` when its measured size allows, which also
    prunes a raw table partitioned by ``on``, and splits hot batches when not.
    """
    return raw.join(done.select(*on).distinct(), list(on), "left_semi")


def partition_range_read(
    table: DataFrame, from_key: str, to_key: str, column: str = "partition_key"
) -> DataFrame:
    """The ``yyyyMM`` partitions from ``from_key`` to ``to_key``, both included."""
    return table.where(F.col(column).between(from_key, to_key))


def project_columns(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """The control row's column list: names, expressions and aliases.

    No list means all columns.
    """
    return df.selectExpr(*columns) if columns else df
