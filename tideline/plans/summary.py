"""Current state to summaries: suites that are ready run their enrichment SQL."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, time
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.functions.keys import partition_key
from tideline.functions.local import small_frame
from tideline.functions.sizing import materialize
from tideline.operators.control import of_suite
from tideline.operators.gate import readiness_gate
from tideline.plans import messages as text
from tideline.plans.enrich import enrich, names_runs, runs_table
from tideline.plans.runs import RunLog, new_job_id, side_by_side
from tideline.sinks.keyed import KeyedTable
from tideline.sinks.landing import run_name, write_enriched
from tideline.sinks.log import LOG_SCHEMA
from tideline.sources.layers import Warehouse

# Without a table of the runs in its SQL, each date is a branch of the plan; a backfill of many is written
# in groups.
DATES_PER_PLAN = 31


def run_summary(
    warehouse: Warehouse,
    control: DataFrame,
    tables: Mapping[str, DataFrame | KeyedTable],
    suite: str | None = None,
    log: DataFrame | None = None,
    daily: bool = False,
    parallel: int = 4,
) -> DataFrame:
    """Run the enrichment of every package whose suite is ready; returns this run's log rows.

    Raw packages of the control table are what a suite requires, its enrich packages
    are what it runs. Suites that are not ready are logged as closed with the reason
    and write nothing. A date that a package has summarised before is due again when a batch of
    the suite that begins on it or before was staged or merged since.
    ``daily`` runs all dates that were ever open, as a backfill does. ``log`` is the
    staging log that the gate reads, by default the warehouse's own.

    The SQL of a package makes the rows of one date; the flow adds ``partition_key``
    and ``summary_date``. SQL that names ``{runs}`` makes the rows of all due dates by one plan; of other SQL up to
    ``DATES_PER_PLAN`` dates are written by one job. An ext table among
    ``tables`` that is partitioned by month is read for the months of the run only. Its current rows of the
    same months are found once and written for all the packages and dates that read them.
    """
    run = RunLog(warehouse, "enrich", suite)
    run.write(run.manager(text.SUMMARY_START, f"SuiteCode: {suite}"))
    with run.guard(text.SUMMARY_ERROR):
        _run(run, control, tables, log, daily, parallel)
    run.write(run.manager(text.SUMMARY_END))
    return run.rows()


def _run(
    run: RunLog,
    control: DataFrame,
    tables: Mapping[str, DataFrame | KeyedTable],
    log: DataFrame | None,
    daily: bool,
    parallel: int,
) -> None:
    warehouse = run.warehouse
    required = control.where(F.col("layer") == "raw")
    own = warehouse.log_state()
    staging = own if log is None else log
    gate = of_suite(readiness_gate(required, staging, daily), run.suite)
    packages = of_suite(control.where(F.col("layer") == "enrich"), run.suite)
    runs = packages.select("control_id", "package_name", "suite_code", "enrich_query").join(
        gate, "suite_code", "left"
    )
    runs = runs.withColumn("status", F.coalesce("status", F.lit("C"))).withColumn(
        "reason", F.when(F.col("status") == "C", F.coalesce("reason", F.lit(text.NO_PACKAGE)))
    )
    start, end = F.col("summary_start_date"), F.col("summary_end_date")
    runs = runs.select(
        "*",
        partition_key(start).alias("from_key"),
        partition_key(end).alias("to_key"),
        new_job_id(run.started, F.col("control_id"), F.col("as_of")).alias("job_id"),
    )
    runs = materialize(runs, "summary-runs")
    changes = own if log is None else own.where("layer = 'ext'").unionByName(log)
    due = _due(runs.where("status = 'S'"), own, _changed(required, changes))
    by_package: dict[int, list[Row]] = {}
    for row in due.collect():
        by_package.setdefault(row["control_id"], []).append(row)
    closed = runs.where("status = 'C'")
    due_rows = [row for rows in by_package.values() for row in rows]
    ids = ";".join(map(str, by_package))
    listed = f"List SummaryControlID = [{ids}]" if ids else text.EMPTY_LIST
    run.write(
        run.manager(f"{text.SUMMARY_COUNT}{len(by_package)}", listed),
        run.packages(closed, text.SUMMARY_PACKAGE_CLOSED, F.col("reason")),
        run.packages(_jobs(warehouse, due_rows), text.SUMMARY_PACKAGE_START),
    )

    inputs = Inputs(tables, by_package.values())

    def summarise(rows: Sequence[Row]) -> None:
        try:
            _summarise(warehouse, run, rows, inputs)
        except Exception as error:
            if len(rows) == 1:
                message = F.lit(f"ERR: {error}")
                jobs = _jobs(warehouse, rows)
                run.write(run.packages(jobs, text.SUMMARY_PACKAGE_ERROR, message, 0, 1))
            else:
                for row in rows:
                    summarise([row])

    def in_groups(rows: Sequence[Row]) -> None:
        step = len(rows) if names_runs(rows[0]["enrich_query"]) else DATES_PER_PLAN
        for first in range(0, len(rows), step):
            summarise(rows[first : first + step])

    side_by_side(warehouse.spark, in_groups, by_package.values(), parallel)


def _changed(required: DataFrame, log: DataFrame) -> DataFrame:
    """For every suite and date, when batches that begin there were last staged or merged."""
    suites = of_suite(required, None).select("control_id", "suite_code").distinct()
    batches = log.where(
        "layer in ('raw', 'ext') and success_flag = 1 and complete_flag = 1 and job_id <> -1"
    ).select("control_id", F.to_date("window_start").alias("date"), "log_time")
    dated = batches.where("date is not null").groupBy("control_id", "date").agg(
        F.max("log_time").alias("changed_at")
    )
    return dated.join(suites, "control_id").groupBy("suite_code", "date").agg(
        F.max("changed_at").alias("changed_at")
    )


def _due(runs: DataFrame, log: DataFrame, changed: DataFrame) -> DataFrame:
    """One run per package and date, without the dates that are summarised and still right.

    A summary is out of date when a batch of its suite that begins on its date or before was staged
    or merged after the summary's run had started.
    """
    done = log.where("layer = 'enrich' and success_flag = 1 and complete_flag = 1").groupBy(
        "control_id", F.to_date("window_start").alias("summary_start_date")
    ).agg(F.max("start_time").alias("done_at"))
    first = runs.groupBy("control_id", "summary_start_date").agg(F.min("as_of").alias("as_of"))
    runs = runs.join(first, ["control_id", "summary_start_date", "as_of"], "left_semi")
    # The last change up to each date: a running maximum over changes and dates in question.
    asked = runs.select("suite_code", F.col("summary_end_date").alias("date")).distinct()
    both = changed.withColumn("asked", F.lit(False)).unionByName(
        asked.withColumns({"changed_at": F.lit(None).cast("timestamp_ntz"), "asked": F.lit(True)})
    )
    so_far = F.max("changed_at").over(W.partitionBy("suite_code").orderBy("date"))
    last = both.withColumn("last_change", so_far).where("asked").select(
        "suite_code", F.col("date").alias("summary_end_date"), "last_change"
    )
    known = runs.join(last, ["suite_code", "summary_end_date"], "left").join(
        done, ["control_id", "summary_start_date"], "left"
    )
    return known.where("done_at is null or last_change > done_at").select(runs.columns)


def _summarise(
    warehouse: Warehouse,
    run: RunLog,
    rows: Sequence[Row],
    inputs: Inputs,
) -> None:
    name, spark = rows[0]["package_name"], warehouse.spark
    if names_runs(rows[0]["enrich_query"]):
        result = _all_dates(spark, rows, inputs)
    else:
        result = reduce(DataFrame.unionByName, [_one_date(spark, row, inputs) for row in rows])
    # The rows count once the log rows below are written; those of earlier jobs do not any more then.
    write_enriched(result, warehouse.path("enrich", name), run_name(run.started))
    jobs = _jobs(warehouse, rows)
    run.write(run.packages(jobs, text.SUMMARY_PACKAGE_DONE, F.lit("OK:"), 1, 1))


def _all_dates(spark: SparkSession, rows: Sequence[Row], inputs: Inputs) -> DataFrame:
    """One plan for any number of dates: each input is read once, and the SQL joins it with the runs."""
    first, last = _span(rows)
    dates = [
        {
            "job_id": row["job_id"],
            "start_date": row["summary_start_date"],
            "end_date": row["summary_end_date"],
            "from_key": row["from_key"],
            "to_key": row["to_key"],
        }
        for row in rows
    ]
    runs = runs_table(spark, dates)
    found = enrich(
        spark,
        rows[0]["enrich_query"],
        min(row["summary_start_date"] for row in rows),
        max(row["summary_end_date"] for row in rows),
        -1,
        first,
        last,
        {"runs": runs, **inputs.read(rows[0]["enrich_query"], first, last)},
    )
    dated = runs.select("job_id", F.col("to_key").alias("partition_key"), F.col("end_date").alias("summary_date"))
    return found.join(dated, "job_id").withColumnRenamed("job_id", "summary_job_id")


def _one_date(spark: SparkSession, row: Row, inputs: Inputs) -> DataFrame:
    months = row["from_key"], row["to_key"]
    found = enrich(
        spark,
        row["enrich_query"],
        row["summary_start_date"],
        row["summary_end_date"],
        row["job_id"],
        *months,
        inputs.read(row["enrich_query"], *months),
    )
    return found.withColumns(
        {
            "partition_key": F.lit(row["to_key"]),
            "summary_date": F.lit(row["summary_end_date"]),
            "summary_job_id": F.lit(row["job_id"]),
        }
    )


def _span(rows: Sequence[Row]) -> tuple[str, str]:
    """The months of some runs."""
    return min(row["from_key"] for row in rows), max(row["to_key"] for row in rows)


class Inputs:
    """The tables that the packages of a run read.

    A keyed table's reader takes the winner of each key of all that was merged. What several packages or
    dates read is found by one such pass and written, for the months that they have in common.
    """

    def __init__(self, tables: Mapping[str, DataFrame | KeyedTable], packages: Iterable[Sequence[Row]]):
        self.tables = tables
        self.readers: Counter[tuple[str, str, str]] = Counter()
        self.written: dict[tuple[str, str, str], DataFrame] = {}
        self.lock = Lock()
        for rows in packages:
            text = rows[0]["enrich_query"]
            months = [_span(rows)] if names_runs(text) else [(row["from_key"], row["to_key"]) for row in rows]
            for name, table in tables.items():
                if isinstance(table, KeyedTable) and f"{{{name}}}" in text:
                    self.readers.update((name, *span) for span in months)

    def read(self, sql_text: str, from_key: str, to_key: str) -> dict[str, DataFrame]:
        """All tables; of those partitioned by month some months."""
        return {name: self._months(name, f"{{{name}}}" in sql_text, from_key, to_key) for name in self.tables}

    def _months(self, name: str, named: bool, from_key: str, to_key: str) -> DataFrame:
        table, asked = self.tables[name], (name, from_key, to_key)
        if isinstance(table, DataFrame):
            return table
        if not named or self.readers[asked] < 2:
            return _current(table, from_key, to_key)
        with self.lock:
            if asked not in self.written:
                self.written[asked] = materialize(_current(table, from_key, to_key), f"summary-{name}")
            return self.written[asked]


def _current(table: KeyedTable, from_key: str, to_key: str) -> DataFrame:
    return table.read() if table.part_by is None else table.read(from_key, to_key)


def _jobs(warehouse: Warehouse, rows: Sequence[Row]) -> DataFrame:
    """The ids and dates of some runs as rows."""
    midnight = time()
    return small_frame(
        warehouse.spark,
        [
            {
                "control_id": row["control_id"],
                "package_name": row["package_name"],
                "suite_code": row["suite_code"],
                "job_id": row["job_id"],
                "window_start": datetime.combine(row["summary_start_date"], midnight),
                "window_end": datetime.combine(row["summary_end_date"], midnight),
            }
            for row in rows
        ],
        LOG_SCHEMA,
    )
