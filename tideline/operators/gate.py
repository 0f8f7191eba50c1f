"""The readiness gate: may a suite be summarised, and for which date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.operators.control import of_suite


def _reached(window_end: Column) -> Column:
    """The last date a window covers; its end is not part of it."""
    return F.to_date(window_end - F.expr("interval 1 microsecond"))


def _daily_successes(log: DataFrame) -> DataFrame:
    """Per package and log date, the date reached by the windows that ended well that day.

    The last completed row of a window on a date decides. A failure on a later date
    takes nothing back: the batch landed before is still there.
    """
    last_row = F.struct("log_time", "log_id")
    return (
        log.where(
            (F.col("layer") == "raw") & (F.col("complete_flag") == 1) & (F.col("job_id") != -1)
        )
        .groupBy("control_id", "window_end", F.to_date("log_time").alias("log_date"))
        .agg(F.max_by("success_flag", last_row).alias("success_flag"))
        .where("success_flag = 1")
        .groupBy("control_id", "log_date")
        .agg(F.max(_reached(F.col("window_end"))).alias("reached"))
    )


def readiness_gate(control: DataFrame, log: DataFrame, daily: bool = False) -> DataFrame:
    """``S`` for suites that may run, ``C`` with the reason for the others.

    A suite may run when all the packages it requires have staged successfully and
    all have reached the same date. ``control`` lists the required packages. With
    ``daily`` the gate is given as of the end of each date in the suite's log,
    without it as of now.
    """
    required = of_suite(control, None).select("control_id", "suite_code").distinct()
    reached = _daily_successes(log)
    days = _log_days(required, log)
    if daily:
        return _every_day(_decide(_frontier_at_changes(days, reached)), days)
    now = reached.groupBy("control_id").agg(F.max("reached").alias("frontier"))
    as_of = days.withColumnRenamed("last", "as_of")
    return _decide(as_of.join(now, "control_id", "left"))


def _log_days(required: DataFrame, log: DataFrame) -> DataFrame:
    """The required packages with the first and last staging log date of their suite, if it has any."""
    staging = log.where(F.col("layer") == "raw")
    per_package = staging.groupBy("control_id").agg(
        F.to_date(F.min("log_time")).alias("first"), F.to_date(F.max("log_time")).alias("last")
    )
    per_suite = (
        required.join(per_package, "control_id")
        .groupBy("suite_code")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
    )
    return required.join(per_suite, "suite_code", "left")


def _frontier_at_changes(days: DataFrame, reached: DataFrame) -> DataFrame:
    """The frontier of every package on the dates on which that of any package of its suite moves, and on
    the first date of its suite's log."""
    so_far = W.partitionBy("control_id").orderBy("log_date")
    moved = reached.withColumn("before", F.max("reached").over(so_far.rowsBetween(W.unboundedPreceding, -1)))
    moved = moved.where("before is null or reached > before").drop("before")
    suites = days.select("control_id", "suite_code")
    dates = moved.join(suites, "control_id").select("suite_code", F.col("log_date").alias("as_of"))
    dates = dates.unionByName(days.select("suite_code", F.col("first").alias("as_of")).where("as_of is not null"))
    asked = suites.join(dates.distinct(), "suite_code")
    at = asked.join(moved.withColumnRenamed("log_date", "as_of"), ["control_id", "as_of"], "left")
    frontier = F.max("reached").over(W.partitionBy("control_id", "suite_code").orderBy("as_of"))
    return at.select("control_id", "suite_code", "as_of", frontier.alias("frontier"))


def _every_day(gate: DataFrame, days: DataFrame) -> DataFrame:
    """The gate of each date: what holds from one change holds until the next, or the end of the suite's log."""
    ends = days.groupBy("suite_code").agg(F.max("last").alias("last"))
    following = F.lead("as_of").over(W.partitionBy("suite_code").orderBy("as_of"))
    until = F.coalesce(F.date_sub(following, 1), F.col("last"))
    held = gate.join(ends, "suite_code").withColumn("until", until)
    return held.withColumn("as_of", F.explode(F.sequence("as_of", "until"))).select(gate.columns)


def _decide(frontiers: DataFrame) -> DataFrame:
    ready = (F.col("package_count") == F.col("total_staging_success_count")) & (
        F.col("summary_start_date") == F.col("summary_end_date")
    )
    reason = F.format_string(
        "Has Closed: package count %d, staged %d, start %s, end %s",
        "package_count",
        "total_staging_success_count",
        F.coalesce(F.col("summary_start_date").cast("string"), F.lit("none")),
        F.coalesce(F.col("summary_end_date").cast("string"), F.lit("none")),
    )
    return (
        frontiers.groupBy("suite_code", "as_of")
        .agg(
            F.count(F.lit(1)).alias("package_count"),
            F.count("frontier").alias("total_staging_success_count"),
            F.min("frontier").alias("summary_start_date"),
            F.max("frontier").alias("summary_end_date"),
        )
        .withColumn("status", F.when(F.coalesce(ready, F.lit(False)), "S").otherwise("C"))
        .withColumn("reason", F.when(F.col("status") == "C", reason))
    )
