"""Source tables to raw batches: each due package reads and lands its next window."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.functions.sizing import materialize
from tideline.operators.control import due_packages, landed_counts, package_list
from tideline.plans import messages as text
from tideline.plans.runs import RunLog, new_job_id, side_by_side
from tideline.sinks.landing import land_raw, run_name
from tideline.sources.jdbc import DRIVERS
from tideline.sources.layers import Warehouse
from tideline.sources.windows import (
    Span,
    due_window_read,
    project_columns,
    window_read,
)

Sources = Mapping[str, DataFrame | Callable[[object, object], DataFrame]]
SOURCE_TYPES = (*DRIVERS, "PARQUET")
# What packages must have in common to be read in one pass; the name is the raw table's.
SHARED = (
    "package_name",
    "source_type",
    "source_table",
    "source_columns",
    "source_key",
    "source_time",
)
WINDOW = ("control_id", "package_name", "suite_code", "job_id", "window_start", "window_end")


def run_staging(
    warehouse: Warehouse,
    control: DataFrame,
    sources: Sources,
    step: timedelta,
    default_start: object,
    as_of: object,
    suite: str | None = None,
    parallel: int = 4,
) -> DataFrame:
    """Land the next window of every package of a suite; returns this run's log rows.

    ``sources`` maps the control rows' source tables to DataFrames, or to functions
    that open one for a time range, as ``jdbc_window_read`` does. A window that ends after ``as_of`` is not complete yet: its
    package is closed for this run. Packages that share a source table are read in
    one pass for each stretch of time their windows cover; when that pass fails they are run in halves, so that the failure is logged
    for the packages it belongs to and the others go on.

    The batch is landed first and logged second: the log row is what makes it count, and the next window
    comes from the log. A run that dies between the two lands the same window again.
    A failure of the run itself is logged as the manager's and raised.
    """
    run = RunLog(warehouse, "raw", suite)
    run.write(run.manager(text.STAGING_START, f"Suite {suite}"))
    with run.guard(text.STAGING_ERROR):
        packages = control.where(F.col("layer") == "raw")
        due = due_packages(packages, warehouse.log_state(), step, default_start, suite)
        _run(run, due, sources, as_of, parallel)
    run.write(run.manager(text.STAGING_END))
    return run.rows()


def _run(run: RunLog, due: DataFrame, sources: Sources, as_of: object, parallel: int) -> None:
    job_id = new_job_id(run.started, F.col("control_id"), F.col("window_start"))
    # Written, because the log it was computed from is about to change.
    due = materialize(with_pass(due.withColumn("job_id", job_id)), "due")
    ready = F.col("window_end") <= F.lit(str(as_of)).cast("timestamp_ntz")
    waiting = due.where(~ready).withColumn("job_id", F.lit(-1))
    due = due.where(ready)
    groups = (
        due.groupBy(*SHARED, "pass")
        .agg(
            F.count(F.lit(1)).alias("packages"),
            *[m.alias(n) for n, m in Span.measures(due.select(*WINDOW).schema).items()],
        )
        .collect()
    )
    if groups:
        listed = _package_lists(run, due)
    else:
        listed = run.manager(text.STAGING_COUNT + "0", text.EMPTY_LIST)
    run.write(
        listed,
        run.packages(waiting.select(*WINDOW), text.STAGING_PACKAGE_CLOSED),
        run.packages(due.select(*WINDOW), text.STAGING_PACKAGE_START),
    )

    def stage(group: Row) -> None:
        members = due
        for name in (*SHARED, "pass"):
            # Lists and nulls are compared as they are.
            members = members.where(F.col(name).eqNullSafe(_literal(group[name])))
        try:
            source = _open(sources, group)
        except Exception as error:
            # No package can do better with a source that does not open.
            _failed(run, members, error)
            return
        try:
            _stage_shared(run, source, group, members)
        except Exception as error:
            if group["packages"] == 1:
                _failed(run, members, error)
            else:
                ids = [row[0] for row in members.select("control_id").collect()]
                _stage_apart(run, source, group, members, ids)

    side_by_side(run.warehouse.spark, stage, groups, parallel)


def with_pass(due: DataFrame) -> DataFrame:
    """Number the passes over each source: windows that touch or overlap are read together.

    A package that is far behind gets a pass over its own window, and does not widen that of the
    others to all the time between.
    """
    shared = F.to_json(F.struct(*SHARED)).alias("shared")
    ordered = W.partitionBy("shared").orderBy("window_start", "window_end")
    so_far = F.max("window_end").over(ordered.rowsBetween(W.unboundedPreceding, -1))
    first = F.coalesce(F.col("window_start") > so_far, F.lit(False)).cast("int")
    # One row per distinct window, however many packages share it.
    windows = due.select(shared, "window_start", "window_end").distinct()
    starts = windows.withColumn("starts", first)
    passes = starts.withColumn("pass", F.sum("starts").over(ordered)).drop("starts")
    keyed = due.withColumn("shared", shared)
    return keyed.join(passes, ["shared", "window_start", "window_end"]).drop("shared")


def _package_lists(run: RunLog, due: DataFrame) -> DataFrame:
    """A manager row per suite with the number and the ids of its due packages."""
    lists = package_list(due, ",").withColumns({"control_id": F.lit(-1), "job_id": F.lit(-1)})
    count = F.concat(F.lit(text.STAGING_COUNT), F.col("package_count").cast("string"))
    ids = F.concat(F.lit("List Of Staging Control ID: ["), F.col("package_list"), F.lit("]"))
    return run.packages(lists, count, ids)


def _literal(value: object):
    return F.array(*[F.lit(part) for part in value]) if isinstance(value, list) else F.lit(value)


def _open(sources: Sources, group: Row) -> DataFrame:
    if group["source_type"] not in SOURCE_TYPES:
        raise ValueError(f"unknown source type {group['source_type']!r}; known: {SOURCE_TYPES}")
    source = sources[group["source_table"]]
    if not isinstance(source, DataFrame):
        source = source(group["first"], group["last"])
    return project_columns(source, group["source_columns"])


def _stage_apart(
    run: RunLog, source: DataFrame, group: Row, members: DataFrame, ids: Sequence[int]
) -> None:
    """Stage the packages of a failed pass in halves, down to the ones that fail alone.

    One bad package among many costs a few more passes and not one per package.
    """
    for half in (ids[: len(ids) // 2], ids[len(ids) // 2 :]):
        part = members.where(F.col("control_id").isin(half))
        try:
            _stage_shared(run, source, group, part)
        except Exception as error:
            if len(half) == 1:
                _failed(run, part, error)
            else:
                _stage_apart(run, source, group, part, half)


def _stage_shared(run: RunLog, source: DataFrame, group: Row, members: DataFrame) -> None:
    name = group["package_name"]
    windows = members.select("control_id", "window_start", "window_end", "job_id")
    if group["source_key"] is not None:
        span = Span(group["first"], group["last"], group["bytes"], group["length"])
        batch = due_window_read(source, windows, group["source_key"], group["source_time"], span)
    else:
        batch = _own_window_read(source, windows, group)
    # What has landed counts once the log rows below are written.
    landed = land_raw(batch, run.warehouse.path("raw", name), run_name(run.started))
    counts = landed_counts(landed, group["source_time"])
    done = (
        members.select(*WINDOW)
        .join(counts.drop("window_end"), ["control_id", "window_start"], "left")
        .withColumn("row_inserted", F.coalesce("row_inserted", F.lit(0)))
        .withColumn("next_start", F.col("window_end"))
    )
    message = F.concat(F.lit(f"OK: {name}: "), F.col("window_end").cast("string"))
    run.write(run.packages(done, text.STAGING_PACKAGE_DONE, message, 1, 1))


def _own_window_read(source: DataFrame, windows: DataFrame, group: Row) -> DataFrame:
    """The window of a package that has its source table to itself."""
    due = windows.take(2)
    if len(due) != 1:
        raise ValueError(f"packages that share {group['source_table']!r} need a source key")
    window = due[0]
    rows = window_read(source, group["source_time"], window["window_start"], window["window_end"])
    return rows.select(
        "*",
        F.lit(window["control_id"]).cast("long").alias("control_id"),
        F.lit(str(window["window_start"])).cast("timestamp_ntz").alias("window_start"),
        F.lit(str(window["window_end"])).cast("timestamp_ntz").alias("window_end"),
        F.lit(window["job_id"]).cast("long").alias("job_id"),
    )


def _failed(run: RunLog, members: DataFrame, error: Exception) -> None:
    message = F.lit(f"ERR: {error}")
    run.write(
        run.packages(members.select(*WINDOW), text.STAGING_PACKAGE_ERROR, message, 0, 1)
    )
