"""Queries on the control table and the execution log."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.keys import partition_key, window_key
from tideline.functions.results import BATCH_MARK, CLOSED_MARK, is_error_row
from tideline.operators.merge import dedupe_latest

CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("control_id", T.LongType()),
        T.StructField("suite_code", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("package_name", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("source_columns", T.ArrayType(T.StringType())),
        T.StructField("source_key", T.StringType()),
        T.StructField("source_time", T.StringType()),
        T.StructField("merge_keys", T.ArrayType(T.StringType())),
        T.StructField("merge_order", T.ArrayType(T.StringType())),
        T.StructField("merge_condition", T.StringType()),
        T.StructField("merge_partition", T.StringType()),
        T.StructField("enrich_query", T.StringType()),
    ]
)


def _done() -> Column:
    """Package rows that report success; -1 marks rows of the manager."""
    return (F.col("success_flag") == 1) & (F.col("complete_flag") == 1) & (F.col("job_id") != -1)


def of_suite(df: DataFrame, suite: str | None) -> DataFrame:
    """Rows of one suite, or all; codes may be padded and are compared trimmed."""
    trimmed = df.withColumn("suite_code", F.trim("suite_code"))
    return trimmed if suite is None else trimmed.where(F.col("suite_code") == suite.strip())


def watermarks(log: DataFrame) -> DataFrame:
    """How far each package has been read: the furthest window end that succeeded."""
    return (
        log.where(_done() & (F.col("layer") == "raw"))
        .groupBy("control_id")
        .agg(F.max("window_end").alias("watermark"))
    )


def due_packages(
    control: DataFrame,
    log: DataFrame,
    step: timedelta,
    default_start: object,
    suite: str | None = None,
) -> DataFrame:
    """The next window of every package: from its watermark, ``step`` long.

    A package that never succeeded starts at ``default_start``. All columns of the
    control row are kept.
    """
    start = F.coalesce("watermark", F.lit(str(default_start)).cast("timestamp_ntz"))
    return (
        of_suite(control, suite)
        .join(watermarks(log), "control_id", "left")
        .withColumn("window_start", start)
        .withColumn("window_end", F.col("window_start") + F.lit(step))
        .drop("watermark")
    )


# What identifies a job: ids of different layers' control tables may be the same.
JOB = ("layer", "control_id", "package_name", "job_id")


def latest_status(log: DataFrame) -> DataFrame:
    """The state of every job of every layer, from its last log row.

    Rows that log a merged batch carry the staging job's id; they are not jobs of their own.
    """
    source = F.coalesce("message_source", F.lit(""))
    jobs = log.where((F.col("job_id") != -1) & ~source.contains(BATCH_MARK)).select(
        *JOB,
        "suite_code",
        "log_time",
        "log_id",
        "success_flag",
        "complete_flag",
        "message_source",
        "message",
    )
    last = dedupe_latest(jobs, JOB, ["log_time", "log_id"])
    closed = F.coalesce(F.col("message_source").contains(CLOSED_MARK), F.lit(False)) | F.coalesce(
        F.col("message").contains(CLOSED_MARK), F.lit(False)
    )
    status = (
        F.when(is_error_row(F.col("success_flag"), F.col("message_source")), "error")
        .when((F.col("success_flag") == 1) & (F.col("complete_flag") == 1), "completed")
        .when(closed, "closed")
        .otherwise("running")
    )
    return last.select(
        *JOB, F.trim("suite_code").alias("suite_code"), "log_time", status.alias("status")
    )


def suite_rollup(log: DataFrame) -> DataFrame:
    """Jobs, packages and outcomes per layer and suite.

    Jobs are first counted per package, so that the shuffle by suite carries one
    partial row per task and not every package of a suite.
    """

    def of(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    per_package = (
        latest_status(log)
        .groupBy("layer", "suite_code", "control_id", "package_name")
        .agg(
            F.count(F.lit(1)).alias("jobs"),
            of("completed").alias("completed"),
            of("error").alias("errors"),
            of("closed").alias("closed"),
        )
    )
    return per_package.groupBy("layer", "suite_code").agg(
        F.sum("jobs").alias("jobs"),
        F.count(F.lit(1)).alias("packages"),
        F.sum("completed").alias("completed"),
        F.sum("errors").alias("errors"),
        F.sum("closed").alias("closed"),
    )


def package_list(control: DataFrame, separator: str = ";") -> DataFrame:
    """The ids of each suite as one text, in numeric order, with their number."""
    return (
        of_suite(control, None)
        .select("suite_code", "control_id")
        .distinct()
        .groupBy("suite_code")
        .agg(
            F.count(F.lit(1)).alias("package_count"),
            F.expr(
                f"listagg(cast(control_id as string), '{separator}')"
                " within group (order by control_id)"
            ).alias("package_list"),
        )
    )


def log_errors(log: DataFrame) -> DataFrame:
    """Rows that report a failure, by flag or by text."""
    return log.where(is_error_row(F.col("success_flag"), F.col("message_source")))


def landed_counts(raw: DataFrame, ts_col: str) -> DataFrame:
    """Rows and first and last time of each landed batch."""
    return raw.groupBy("control_id", "window_start", "window_end").agg(
        F.count(F.lit(1)).alias("row_inserted"),
        F.min(ts_col).alias("first_ts"),
        F.max(ts_col).alias("last_ts"),
    )


def staged_batches(log: DataFrame) -> DataFrame:
    """The batches that are complete in raw, with the job that last staged them and its run's start."""
    last = F.max_by(F.struct("job_id", "start_time"), F.struct("log_time", "log_id"))
    return (
        log.where(_done() & (F.col("layer") == "raw"))
        .groupBy("control_id", "window_start", "window_end")
        .agg(last.alias("last"))
        .select("control_id", "window_start", "window_end", "last.*")
        .withColumn("window_key", window_key(F.col("window_start")))
    )


def summary_jobs(log: DataFrame, package_name: str) -> DataFrame:
    """The jobs whose rows of a summary table count: the last that is done for each window, by the
    month that the window ends in, with their run's start."""
    done = log.where(_done() & (F.col("layer") == "enrich") & (F.col("package_name") == package_name))
    last = F.max_by(F.struct(F.col("job_id").alias("summary_job_id"), "start_time"), F.struct("log_time", "log_id"))
    by_window = done.groupBy("control_id", "window_start", "window_end").agg(last.alias("last"))
    return by_window.select(partition_key(F.col("window_end")).alias("partition_key"), "last.*")


def pending_batches(log: DataFrame, package_name: str, suite: str | None = None) -> DataFrame:
    """Staged batches that the named ext package has not merged yet.

    A package is known by its name and suite. The rows that log a merged batch carry the job that
    staged it, so a batch that was staged again is pending again, whatever the clocks say.
    """
    merged = of_suite(log, suite).where(
        _done() & (F.col("layer") == "ext") & (F.col("package_name") == package_name)
    )
    return staged_batches(log).join(
        merged.select("control_id", "window_start", "job_id"),
        ["control_id", "window_start", "job_id"],
        "left_anti",
    )
