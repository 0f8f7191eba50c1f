"""Control and log tables derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import CONTROL_SCHEMA
from tideline.sinks import conform_log

# The feeds of the events table: their number stays the same as the data grows.
FEEDS = 12
SUITES = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _log(events: DataFrame, control_id, suite_code) -> DataFrame:
    """A log of one row per event; the event type decides what the row reports."""
    kind = F.col("event_type")
    handler = (kind == "signup") & (F.col("event_id") % 10 == 0)
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return conform_log(
        events.select(
            F.col("event_id").alias("log_id"),
            F.col("ts").alias("log_time"),
            F.lit("raw").alias("layer"),
            control_id.alias("control_id"),
            suite_code.alias("suite_code"),
            F.when(kind == "signup", -1)
            .otherwise(F.col("user_id") * 100 + F.dayofmonth("ts"))
            .alias("job_id"),
            F.when(kind == "error", 0).otherwise(1).alias("success_flag"),
            F.when(kind.isin("error", "purchase"), 1).otherwise(0).alias("complete_flag"),
            F.when(kind == "error", "Copy Has ERROR: ")
            .when(kind == "purchase", "Has Been Completed")
            .when(handler, "Manage Exception Has ERROR: ")
            .when(kind == "signup", "Manage Start")
            .otherwise("Execution Starting")
            .alias("message_source"),
            F.when(kind == "error", F.concat(F.lit("ERR:"), "props"))
            .when(kind == "purchase", F.concat(F.lit("OK:"), "props"))
            .when((kind == "view") & (F.col("event_id") % 2 == 0), "Has Closed")
            .otherwise("")
            .alias("message"),
            day.alias("window_start"),
            (day + F.expr("interval 1 day")).alias("window_end"),
        )
    )


def user_log(events: DataFrame) -> DataFrame:
    """Every user is a package: many packages and jobs."""
    suite = F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string"))
    return _log(events, F.col("user_id"), suite)


def user_control(log: DataFrame) -> DataFrame:
    """The packages of the user log; half of the suite codes are padded."""
    padded = F.concat(F.lit(" "), "suite_code", F.lit("  "))
    return log.select("control_id", "suite_code").distinct().select(
        "control_id",
        F.when(F.col("control_id") % 2 == 0, padded).otherwise(F.col("suite_code")).alias("suite_code"),
    )


def with_feed(events: DataFrame) -> DataFrame:
    """The events with the feed they come from and its suite."""
    return events.withColumns(
        {
            "feed_id": F.col("user_id") % FEEDS,
            "feed_suite": F.concat(F.lit("T"), (F.col("user_id") % SUITES).cast("string")),
        }
    )


def feed_log(events: DataFrame) -> DataFrame:
    """Every feed is a package: few packages, many rows each."""
    return _log(with_feed(events), F.col("feed_id"), F.col("feed_suite"))


def control_rows(base: DataFrame, **columns: object) -> DataFrame:
    """Control rows from ``base``, with plain values for some columns and null for the rest."""
    there = set(base.columns)
    out = []
    for field in CONTROL_SCHEMA.fields:
        value = columns.get(field.name)
        if isinstance(value, list):
            value = F.array(*[F.lit(part) for part in value])
        column = F.col(field.name) if field.name in there else value
        if not hasattr(column, "alias"):
            column = F.lit(column)
        out.append(column.cast(field.dataType).alias(field.name))
    return base.select(*out)


def feed_control(events: DataFrame) -> DataFrame:
    """The raw packages of the feeds: all read the events table by feed."""
    feeds = with_feed(events).select(
        F.col("feed_id").alias("control_id"), F.col("feed_suite").alias("suite_code")
    )
    return control_rows(
        feeds.distinct(),
        layer="raw",
        package_name="events",
        source_type="PARQUET",
        source_table="events",
        source_key="feed_id",
        source_time="ts",
    )


def ext_control(spark: SparkSession) -> DataFrame:
    """Ext packages over one raw table: plain, with a condition, and partitioned by month."""
    latest = control_rows(
        spark.range(1),
        suite_code="X",
        layer="ext",
        package_name="user_latest",
        source_table="events",
        source_columns=["user_id", "ts", "event_id", "event_type", "value"],
        merge_keys=["user_id"],
        merge_order=["ts", "event_id"],
    )
    record = control_rows(
        spark.range(1),
        suite_code="X",
        layer="ext",
        package_name="user_record",
        source_table="events",
        source_columns=["user_id", "event_type", "ts", "event_id", "value"],
        merge_keys=["user_id", "event_type"],
        merge_order=["ts", "event_id"],
        merge_condition="source.value > target.value",
    )
    # An event never changes its month, so the key may hold it and partition the table.
    by_month = control_rows(
        spark.range(1),
        suite_code="X",
        layer="ext",
        package_name="events_by_month",
        source_table="events",
        source_columns=[
            "event_id",
            "date_format(ts, 'yyyyMM') AS partition_key",
            "ts",
            "user_id",
            "event_type",
            "value",
            "feed_suite",
        ],
        merge_keys=["partition_key", "event_id"],
        merge_order=["ts"],
        merge_partition="partition_key",
    )
    return latest.unionByName(record).unionByName(by_month)


def summary_control(spark: SparkSession, sql: str) -> DataFrame:
    """One enrich package per suite, all with the same SQL but for the suite's name."""
    suites = spark.range(SUITES).select(
        (F.col("id") + 1000).alias("control_id"),
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("suite_code"),
    )
    named = suites.select(
        "*",
        F.concat(F.lit("summary_"), "suite_code").alias("package_name"),
        F.replace(F.lit(sql), F.lit("$suite"), F.col("suite_code")).alias("enrich_query"),
    )
    return control_rows(named, layer="enrich")
