"""Raw batches to current state: each package merges what was staged since it last ran."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tideline.functions.local import small_frame
from tideline.functions.sizing import materialize_measured
from tideline.operators.control import of_suite, pending_batches
from tideline.plans import messages as text
from tideline.plans.runs import RunLog, side_by_side
from tideline.sinks.log import LOG_SCHEMA
from tideline.sources.layers import NoData, Warehouse
from tideline.sources.windows import partition_range_read, project_columns


def run_extract(
    warehouse: Warehouse, control: DataFrame, suite: str | None = None, parallel: int = 4
) -> DataFrame:
    """Merge all pending batches of every package of a suite; returns this run's log rows.

    All pending batches of a package go into one merge: its latest row per key is
    the same as after merging them one by one. With a merge condition that does not hold, as a row
    may meet it that a later one does not: such a package folds the latest rows of each window, one
    window after the other, so its result does not depend on how often the flow runs.

    A package is known by its name and suite. Packages of one name share a table and run one
    after the other, others side by side.

    Each merged batch is logged, so the next run leaves it out unless it was staged
    again. A run that dies between the merge and the log repeats the merge, which
    changes nothing. A failure of the run itself is logged as the manager's and raised.
    """
    run = RunLog(warehouse, "ext", suite)
    run.write(run.manager(text.EXTRACT_START))
    with run.guard(text.EXTRACT_ERROR):
        _run(warehouse, control, run, parallel)
    run.write(run.manager(text.EXTRACT_END))
    return run.rows()


def _run(warehouse: Warehouse, control: DataFrame, run: RunLog, parallel: int) -> None:
    packages = of_suite(control.where(F.col("layer") == "ext"), run.suite).collect()
    names = ";".join(package["package_name"] for package in packages)
    count = f"{text.EXTRACT_COUNT}{len(packages)}"
    jobs = [(package, _job(warehouse, package)) for package in packages]
    starting = [run.packages(job, text.EXTRACT_PACKAGE_START) for _, job in jobs]
    listed = f"List Extract Package: [{names}]" if packages else text.EMPTY_LIST
    run.write(run.manager(count, listed), *starting)
    staging = control.where(F.col("layer") == "raw").select("control_id", "package_name")
    by_table: dict[str, list[tuple[Row, DataFrame]]] = {}
    for package, job in jobs:
        by_table.setdefault(package["package_name"], []).append((package, job))

    def extract(members: list[tuple[Row, DataFrame]]) -> None:
        for package, job in members:
            try:
                _extract(warehouse, run, package, staging, job)
            except NoData as error:
                run.write(run.packages(job, text.EXTRACT_PACKAGE_CLOSED, F.lit(str(error))))
            except Exception as error:
                message = F.lit(f"ERR: {error}")
                run.write(run.packages(job, text.EXTRACT_PACKAGE_ERROR, message, 0, 1))

    side_by_side(warehouse.spark, extract, by_table.values(), parallel)


def _job(warehouse: Warehouse, package: Row) -> DataFrame:
    """The ids of a package's job as a row; a package of this layer has no control id."""
    row = {
        "control_id": -1,
        "package_name": package["package_name"],
        "suite_code": package["suite_code"],
        "job_id": uuid.uuid4().int >> 65,
    }
    return small_frame(warehouse.spark, [row], LOG_SCHEMA)


def _extract(
    warehouse: Warehouse, run: RunLog, package: Row, staging: DataFrame, job: DataFrame
) -> None:
    name, table = package["package_name"], package["source_table"]
    feeding = staging.where(F.col("package_name") == table)
    pending = pending_batches(warehouse.log_state(), name, package["suite_code"])
    pending = pending.join(feeding, "control_id", "left_semi")
    # Written, because the log it was computed from is about to change.
    pending, seen = materialize_measured(
        pending, "pending", first=F.min("window_key"), last=F.max("window_key")
    )
    if seen["first"] is None:
        message = F.lit("no batch is pending")
        run.write(run.packages(job, text.EXTRACT_PACKAGE_CLOSED, message))
        return
    target = warehouse.ext(name, package["merge_keys"], package["merge_partition"])
    # Only folders of the pending runs are read; the key range prunes row groups in them.
    batch = partition_range_read(warehouse.raw(table, pending), seen["first"], seen["last"], "window_key")
    step = "window_key AS _step" if package["merge_condition"] else None
    merged = target.merge(
        project_columns(batch, _with_step(package["source_columns"], step)),
        order=package["merge_order"],
        when=package["merge_condition"],
        steps=step and "_step",
    )
    batches = pending.withColumns(
        {"package_name": F.lit(name), "suite_code": F.lit(package["suite_code"])}
    )
    message = F.lit(f"OK: version {merged.version}")
    run.write(run.packages(batches, text.EXTRACT_BATCH_DONE, message, 1, 1))
    done = job.withColumn("row_inserted", F.lit(merged.source_rows))
    run.write(run.packages(done, text.EXTRACT_PACKAGE_DONE, message, 1, 1))


def _with_step(columns: list[str] | None, step: str | None) -> list[str] | None:
    return columns if step is None else [*(columns or ["*"]), step]
