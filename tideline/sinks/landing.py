"""Sinks that write a folder for each run; a row of the log makes what is in it count.

Nothing is overwritten, deleted or read back: rows carry the id of the job that wrote them, and readers take
those of jobs that the log says are done. What a run has half written, or a later run has replaced, is
in no reader's way.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.keys import window_key
from tideline.functions.local import nullable
from tideline.sinks.files import file_system, names, read_small, write_once


def run_name(started: datetime) -> str:
    """The folder of a run, by the start time that its log rows carry."""
    return started.strftime("%Y%m%dT%H%M%S%f")


def land_raw(df: DataFrame, path: str, run: str) -> DataFrame:
    """Land rows of some windows; gives them as they were written.

    ``df`` has ``control_id``, ``window_start``, ``window_end`` and ``job_id``. REBALANCE brings the rows of a batch
    together and lets AQE cut a large one into several files, so no task holds a whole hot batch.
    """
    keyed = df.withColumn("window_key", window_key(F.col("window_start")))
    folder = _write(keyed.hint("rebalance", "control_id", "window_key"), path, run)
    return _read(df.sparkSession, [folder], keyed.schema)


def write_enriched(df: DataFrame, path: str, run: str) -> None:
    """Write summary rows, which have ``partition_key`` and ``summary_job_id``, by month."""
    _write(df.hint("rebalance", "partition_key"), path, run, ["partition_key"])


def _write(df: DataFrame, path: str, run: str, by: Sequence[str] = ()) -> str:
    """One pass of a run, in a folder that no other writer uses; its schema is kept beside the data."""
    _keep_schema(df.sparkSession, path, df.schema)
    folder = f"{path}/data/run={run}/pass={uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(folder)
    return folder


def _keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    text = json.dumps(nullable(schema).jsonValue())
    digest = hashlib.sha256(text.encode()).hexdigest()[:16]
    known = names(spark, f"{path}/schemas")
    if not any(name.endswith(digest) for name in known):
        write_once(spark, f"{path}/schemas/{len(known):04d}-{digest}", text)


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns of all that was ever written; None if nothing was."""
    fields: dict[str, T.StructField] = {}
    for name in names(spark, f"{path}/schemas"):
        for field in T.StructType.fromJson(json.loads(read_small(spark, f"{path}/schemas/{name}"))).fields:
            if fields.setdefault(field.name, field).dataType != field.dataType:
                raise ValueError(f"{path} has the column {field.name!r} in two types")
    return T.StructType(list(fields.values())) if fields else None


def _read(spark: SparkSession, folders: Sequence[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*folders)


def read_raw(spark: SparkSession, path: str, batches: DataFrame) -> DataFrame | None:
    """The landed rows of ``batches``: ``control_id``, ``window_key``, ``job_id`` and the ``start_time`` of
    the run; None if nothing was ever landed.

    Only folders of the runs that the batches name are listed, however many there are.
    """
    schema = stored_schema(spark, path)
    if schema is None:
        return None
    # A row per run that is still to be read, not per batch.
    runs = [r["start_time"] for r in batches.select("start_time").distinct().collect()]
    files, _ = file_system(spark, path)
    folders = [f"{path}/data/run={run_name(run)}" for run in runs if run is not None]
    there = [f for f in folders if files.exists(file_system(spark, f)[1])]
    keys = ["control_id", "window_key", "job_id"]
    rows = _read(spark, there, schema) if there else spark.createDataFrame([], schema)
    return rows.join(batches.select(*keys).distinct(), keys, "left_semi").select(schema.names)


def read_enriched(spark: SparkSession, path: str, jobs: DataFrame) -> DataFrame | None:
    """The summary rows of ``jobs`` (``partition_key``, ``summary_job_id``); None if nothing was ever written.

    A filter on the months prunes their folders.
    """
    schema = stored_schema(spark, path)
    if schema is None:
        return None
    rows = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(f"{path}/data")
    return rows.join(jobs.distinct(), ["partition_key", "summary_job_id"], "left_semi").select(schema.names)


def audited(df: DataFrame, job_id: int, control_id: int, start: object, end: object) -> DataFrame:
    """Rows of one window of one package with the columns that landing needs."""
    return df.select(
        "*",
        F.lit(control_id).cast("long").alias("control_id"),
        F.lit(str(start)).cast("timestamp_ntz").alias("window_start"),
        F.lit(str(end)).cast("timestamp_ntz").alias("window_end"),
        F.lit(job_id).cast("long").alias("job_id"),
    )


def month_keys(from_key: str, to_key: str) -> Column:
    """All ``yyyyMM`` keys of a closed range, as an array column."""
    return F.transform(_months(from_key, to_key), lambda day: F.date_format(day, "yyyyMM"))


def month_windows(spark: SparkSession, from_key: str, to_key: str) -> DataFrame:
    """A row for each month of a closed range: its first and its last day, as log rows have them."""
    first = spark.range(1).select(F.explode(_months(from_key, to_key)).alias("first"))
    return first.select(
        F.col("first").cast("timestamp_ntz").alias("window_start"),
        F.last_day("first").cast("timestamp_ntz").alias("window_end"),
    )


def _months(from_key: str, to_key: str) -> Column:
    bounds = [F.to_date(F.lit(key), "yyyyMM") for key in (from_key, to_key)]
    return F.sequence(*bounds, F.expr("interval 1 month"))
