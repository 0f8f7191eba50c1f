"""Enrichment: the SQL text of a control row, run with bound parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tideline.functions.local import small_frame


# What a text that names the runs gets for each of them.
RUNS = T.StructType(
    [
        T.StructField("job_id", T.LongType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("from_key", T.StringType()),
        T.StructField("to_key", T.StringType()),
    ]
)


def names_runs(sql_text: str) -> bool:
    return "{runs}" in sql_text


def runs_table(spark: SparkSession, runs: Sequence[Mapping[str, object]]) -> DataFrame:
    """The due runs of a package as a table."""
    return small_frame(spark, runs, RUNS)


def enrich(
    spark: SparkSession,
    sql_text: str,
    start: object,
    end: object,
    job_id: int,
    from_key: str,
    to_key: str,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The result of ``sql_text`` for one summary run.

    The text may use the markers ``:start``, ``:end``, ``:job_id``, ``:from_key``
    and ``:to_key``, and ``{name}`` for each entry of ``tables``. Values are bound,
    never pasted into the text, so nothing needs quoting. The key range is meant
    for the partition column of the inputs: ``partition_key between :from_key and
    :to_key`` prunes the scan to those months.
    """
    parameters = {
        "start": str(start),
        "end": str(end),
        "job_id": job_id,
        "from_key": from_key,
        "to_key": to_key,
    }
    return spark.sql(sql_text, args=parameters, **(tables or {}))
