"""The append-only execution log."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.local import small_frame
from tideline.functions.sizing import materialize
from tideline.operators.control import JOB
from tideline.sinks.files import delete, file_system, names, read_small, write_once

LOG_SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.LongType()),
        T.StructField("log_time", T.TimestampNTZType()),
        T.StructField("layer", T.StringType()),
        T.StructField("package_name", T.StringType()),
        T.StructField("control_id", T.LongType()),
        T.StructField("job_id", T.LongType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("success_flag", T.IntegerType()),
        T.StructField("complete_flag", T.IntegerType()),
        T.StructField("message_source", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("message_type", T.StringType()),
        T.StructField("suite_code", T.StringType()),
        T.StructField("row_inserted", T.LongType()),
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("next_start", T.TimestampNTZType()),
    ]
)


def conform_log(rows: DataFrame) -> DataFrame:
    """``rows`` with exactly the log's columns; ones it lacks are null."""
    there = set(rows.columns)
    return rows.selectExpr(
        *[
            f"cast({f.name if f.name in there else 'null'} as {f.dataType.simpleString()}) {f.name}"
            for f in LOG_SCHEMA.fields
        ]
    )


def append_log(
    spark: SparkSession, path: str, rows: DataFrame | Iterable[Mapping[str, object]]
) -> None:
    """Append typed rows; messages are stored as given.

    Every append is a folder of its own, written by a job of its own: appends of any number of
    threads, sessions or drivers share nothing that one could take from another.

    A DataFrame's rows never pass through the driver, however many packages they
    are for. Mappings are for the few rows a flow writes about itself.
    """
    if not isinstance(rows, DataFrame):
        rows = log_rows(spark, rows)
    conform_log(rows).write.parquet(f"{path}/appends/{uuid.uuid4().hex}")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All rows that were ever appended."""
    last = _last(spark, path)
    folders = [f"{path}/compacted/{name}" for name in [*last["rests"], *last["state"]]]
    return _read(spark, folders + _appends(spark, path, last))


def log_state(spark: SparkSession, path: str) -> DataFrame:
    """The rows that flows and status reports decide by: those that the last compaction kept, and all that were
    appended since.

    How many files that reads depends on what was appended since, not on how often flows ran.
    """
    last = _last(spark, path)
    kept = [f"{path}/compacted/{name}" for name in last["state"]]
    return _read(spark, kept + _appends(spark, path, last))


def compact_log(
    spark: SparkSession, path: str, appends: int = 64, keep: timedelta = timedelta(days=1)
) -> bool:
    """Fold the appends since the last compaction into its state, once there are ``appends`` of them.

    The state keeps the outcomes of all jobs, the last row of each job, and the first and the last row of each package: the
    answers of the operators on the log are the same before and after. The other rows go where only
    ``read_log`` looks. A compaction counts once its number is taken, which one of several drivers can; appended
    folders that one has covered are deleted after ``keep``.
    """
    last = _last(spark, path)
    found = _appends(spark, path, last)
    if len(found) < appends:
        return False
    # An append that is still being written waits for the next compaction.
    files, _ = file_system(spark, path)
    found = [f for f in found if files.exists(file_system(spark, f"{f}/_SUCCESS")[1])]
    log = _read(spark, [f"{path}/compacted/{name}" for name in last["state"]] + found)
    outcome = (F.col("complete_flag") == 1) & (F.col("job_id") != -1)
    newest = W.partitionBy(*JOB).orderBy(F.desc_nulls_last("log_time"), F.desc_nulls_last("log_id"))
    package = W.partitionBy("layer", "control_id")
    ends = (F.col("log_time") == F.min("log_time").over(package)) | (F.col("log_time") == F.max("log_time").over(package))
    last_of_job = (F.col("job_id") != -1) & (F.row_number().over(newest) == 1)
    marked = log.withColumn("_state", F.coalesce(outcome, F.lit(False)) | last_of_job | F.coalesce(ends, F.lit(False)))
    name = f"{last['number'] + 1:08d}-{uuid.uuid4().hex}"
    marked = materialize(marked, "log")
    for keeps, folder in ((True, "state"), (False, "rest")):
        rows = marked.where(F.col("_state") == keeps).drop("_state")
        rows.coalesce(1 + len(found) // 1024).write.parquet(f"{path}/compacted/{name}/{folder}")
    covers = {f.rsplit("/", 1)[1] for f in found}
    # Covered folders that are still there have to stay covered.
    covers |= set(last["covers"]) & set(names(spark, f"{path}/appends"))
    record = {"name": name, "covers": sorted(covers), "state": [f"{name}/state"], "rests": [*last["rests"], f"{name}/rest"]}
    taken = json.loads(write_once(spark, f"{path}/compactions/{last['number'] + 1:08d}", json.dumps(record)))
    if taken["name"] != name:
        delete(spark, f"{path}/compacted/{name}")  # another driver was first
        return False
    until = (time.time() - keep.total_seconds()) * 1000
    for old in last["covers"]:
        files, place = file_system(spark, f"{path}/appends/{old}")
        if files.exists(place) and files.getFileStatus(place).getModificationTime() < until:
            delete(spark, f"{path}/appends/{old}")
    return True


def _last(spark: SparkSession, path: str) -> dict:
    """The last compaction: its number, the appends that it and earlier ones cover, where its state is, and
    where the rows are that it and earlier ones put aside."""
    numbers = names(spark, f"{path}/compactions")
    if not numbers:
        return {"number": 0, "covers": [], "state": [], "rests": []}
    return {"number": int(numbers[-1]), **json.loads(read_small(spark, f"{path}/compactions/{numbers[-1]}"))}


def _appends(spark: SparkSession, path: str, last: dict) -> list[str]:
    covered = set(last["covers"])
    return [f"{path}/appends/{name}" for name in names(spark, f"{path}/appends") if name not in covered]


def _read(spark: SparkSession, folders: list[str]) -> DataFrame:
    if not folders:
        return small_frame(spark, [], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(*folders)


def log_rows(spark: SparkSession, rows: Iterable[Mapping[str, object]]) -> DataFrame:
    return small_frame(spark, list(rows), LOG_SCHEMA)
