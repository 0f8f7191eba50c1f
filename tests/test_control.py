from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from checks import derive
from tests.conftest import rows
from tideline.functions import partition_key, result_class, window_key
from tideline.operators import gate
from tideline.operators import (
    due_packages,
    latest_status,
    log_errors,
    package_list,
    pending_batches,
    readiness_gate,
    suite_rollup,
    watermarks,
)
from tideline.sinks import conform_log


def log_of(spark, *lines: str):
    """Log rows of layer raw from ``control, job, day, success, complete, source`` texts.

    A line may add the log date; by default that is the window's own day.
    """
    values = []
    for i, line in enumerate(lines):
        control, job, day, success, complete, source, *logged = [p.strip() for p in line.split(",")]
        stamp = f"{logged[0] if logged else day} 12:00:00"
        values.append(
            f"({i}, timestamp_ntz'{stamp}', 'raw', {control}L, {job}L, {success}, {complete},"
            f" '{source}', timestamp_ntz'{day}')"
        )
    columns = (
        "log_id, log_time, layer, control_id, job_id, success_flag, complete_flag,"
        " message_source, window_start"
    )
    df = spark.sql(f"select * from values {','.join(values)} as t({columns})")
    return conform_log(
        df.withColumns(
            {
                "window_end": F.col("window_start") + F.expr("interval 1 day"),
                "suite_code": F.lit("A"),
                "message": F.lit(""),
            }
        )
    )


def control_of(spark, *ids: int, suite: str = "A"):
    return spark.range(1).select(
        F.explode(F.array(*[F.lit(i).cast("long") for i in ids])).alias("control_id"),
        F.lit(suite).alias("suite_code"),
    )


@pytest.mark.parametrize(
    "message, want",
    [
        ("Error: x", "error"),
        ("ERR:x", "error"),
        ("ERR", "error"),
        ("error: x", "complete"),
        ("ERROR: x", "complete"),
        (" ERR: x", "complete"),
        ("ok", "complete"),
        ("", "complete"),
        (None, "complete"),
    ],
)
def test_result_class(spark, message, want):
    df = spark.range(1).select(result_class(F.lit(message).cast("string")).alias("r"))
    assert df.first()["r"] == want


def test_month_keys_at_the_ends_of_months_and_years(spark):
    days = ["2023-12-31 23:59:59.999999", "2024-01-01", "2024-02-29"]
    got = [
        spark.range(1).select(partition_key(F.lit(d).cast("timestamp_ntz"))).first()[0] for d in days
    ]
    assert got == ["202312", "202401", "202402"]


def test_windows_a_microsecond_apart_have_other_keys(spark):
    stamps = ["2024-01-01 00:00:00", "2024-01-01 00:00:00.000001"]
    got = {spark.range(1).select(window_key(F.lit(s).cast("timestamp_ntz"))).first()[0] for s in stamps}
    assert got == {"w20240101T000000000000", "w20240101T000000000001"}


def test_only_success_moves_the_watermark(spark):
    log = log_of(
        spark,
        "1, 5, 2024-01-01, 0, 1, Copy Has ERROR",
        "1, 6, 2024-01-01, 1, 0, Starting",
        "1, 7, 2024-01-01, 1, 1, Done",
        "1, 8, 2024-01-02, 0, 1, Copy Has ERROR",
        "1, -1, 2024-01-09, 1, 1, Manager",
        "2, 9, 2024-01-05, 0, 1, Copy Has ERROR",
    )
    got = [(c, str(w)) for c, w in rows(watermarks(log))]
    assert got == [(1, "2024-01-02 00:00:00")]


def test_other_layers_do_not_move_the_watermark(spark):
    log = log_of(spark, "1, 7, 2024-01-01, 1, 1, Done").withColumn("layer", F.lit("ext"))
    assert watermarks(log).isEmpty()


def test_suite_codes_are_compared_trimmed(spark):
    control = control_of(spark, 1, suite=" S3 ").union(control_of(spark, 2, suite="S3"))
    control = control.union(control_of(spark, 3, suite="S4"))
    log = log_of(spark, "1, 7, 2024-01-01, 1, 1, Done")
    got = rows(due_packages(control, log, timedelta(days=7), "2023-06-01", suite="S3 "))
    assert [(c, s, str(a), str(b)) for c, s, a, b in got] == [
        (1, "S3", "2024-01-02 00:00:00", "2024-01-09 00:00:00"),
        (2, "S3", "2023-06-01 00:00:00", "2023-06-08 00:00:00"),
    ]


def test_latest_status_is_of_the_last_row(spark):
    log = log_of(
        spark,
        "1, 1, 2024-01-01, 1, 0, Starting",
        "1, 1, 2024-01-01, 1, 1, Done",
        "1, 2, 2024-01-01, 1, 1, Done",
        "1, 2, 2024-01-01, 0, 1, Copy failed",
        "1, 3, 2024-01-01, 1, 0, Exception Has ERROR",
        "1, 4, 2024-01-01, 1, 0, Values Has Closed",
        "1, 5, 2024-01-01, 1, 0, Starting",
        "1, -1, 2024-01-01, 1, 0, Manager",
    )
    got = {r["job_id"]: r["status"] for r in latest_status(log).collect()}
    assert got == {1: "completed", 2: "error", 3: "error", 4: "closed", 5: "running"}
    assert rows(suite_rollup(log)) == [("raw", "A", 5, 1, 1, 2, 1)]


def test_jobs_of_other_layers_are_jobs_of_their_own(spark):
    raw = log_of(spark, "1, 7, 2024-01-01, 1, 1, Done", "2, 8, 2024-01-01, 1, 1, Done")
    # An ext package logs its own job, and the staging job of each batch that it merged.
    ext = {"layer": F.lit("ext"), "package_name": F.lit("p"), "suite_code": F.lit("X")}
    job = log_of(spark, "-1, 70, 2024-01-01, 1, 1, Done").withColumns(ext)
    batches = raw.withColumns(ext).withColumn(
        "message_source", F.lit("Log Extract Execution Batch Has Been Completed")
    )
    # An id of another control table may be the same.
    enrich = log_of(spark, "1, 7, 2024-01-01, 0, 1, Has ERROR").withColumn("layer", F.lit("enrich"))
    log = raw.union(job).union(batches).union(enrich)
    assert rows(suite_rollup(log)) == [
        ("enrich", "A", 1, 1, 0, 1, 0), ("ext", "X", 1, 1, 1, 0, 0), ("raw", "A", 2, 2, 2, 0, 0),
    ]


def test_errors_are_found_by_flag_and_by_text(spark):
    log = log_of(
        spark,
        "1, 1, 2024-01-01, 0, 1, Copy failed",
        "1, 2, 2024-01-01, 1, 0, Exception Has ERROR",
        "1, 3, 2024-01-01, 1, 1, Done",
    )
    assert sorted(r["job_id"] for r in log_errors(log).collect()) == [1, 2]


def test_package_lists_are_in_numeric_order(spark):
    control = control_of(spark, 10, 9, 100).union(control_of(spark, 9, suite=" A "))
    assert rows(package_list(control, ",")) == [("A", 3, "9,10,100")]


def test_a_batch_is_pending_until_merged_and_again_when_staged_again(spark):
    staged = log_of(spark, "1, 7, 2024-01-01, 1, 1, Done", "2, 8, 2024-01-01, 1, 1, Done")
    merged = log_of(spark, "1, 7, 2024-01-01, 1, 1, Merged").withColumns(
        {"layer": F.lit("ext"), "package_name": F.lit("p")}
    )
    again = log_of(spark, "1, 9, 2024-01-01, 1, 1, Done, 2024-01-03")

    def ids(log, name):
        return sorted((r["control_id"], r["job_id"]) for r in pending_batches(log, name).collect())

    assert ids(staged, "p") == [(1, 7), (2, 8)]
    assert ids(staged.union(merged), "p") == [(2, 8)]
    # The package of another suite has merged nothing.
    assert rows(pending_batches(staged.union(merged), "p", "B").select("job_id")) == [(7,), (8,)]
    assert rows(pending_batches(staged.union(merged), "p", " A").select("job_id")) == [(8,)]
    assert ids(staged.union(merged), "other") == [(1, 7), (2, 8)]
    assert ids(staged.union(merged).union(again), "p") == [(1, 9), (2, 8)]


class TestGate:
    def gate(self, spark, control, *lines, daily=False):
        got = readiness_gate(control, log_of(spark, *lines), daily)
        return {str(r["as_of"]): r for r in got.collect()}

    def test_open_when_all_reached_the_same_date(self, spark):
        lines = ["1, 7, 2024-01-01, 1, 1, Done", "2, 8, 2024-01-01, 1, 1, Done"]
        (row,) = self.gate(spark, control_of(spark, 1, 2), *lines).values()
        assert (row["status"], row["reason"]) == ("S", None)
        assert str(row["summary_start_date"]) == str(row["summary_end_date"]) == "2024-01-01"

    def test_rows_of_other_layers_do_not_count(self, spark):
        control = control_of(spark, 1)
        raw = log_of(spark, "1, 7, 2024-01-01, 1, 1, Done")
        later = log_of(spark, "1, 9, 2024-03-01, 1, 1, Done").withColumn("layer", F.lit("enrich"))
        (row,) = readiness_gate(control, raw.union(later), daily=True).collect()
        assert (row["status"], str(row["as_of"])) == ("S", "2024-01-01")

    def test_closed_when_a_package_is_missing(self, spark):
        lines = ["1, 7, 2024-01-01, 1, 1, Done", "2, 8, 2024-01-01, 0, 1, Has ERROR"]
        (row,) = self.gate(spark, control_of(spark, 1, 2, 3), *lines).values()
        assert (row["status"], row["package_count"], row["total_staging_success_count"]) == ("C", 3, 1)
        assert row["reason"].startswith("Has Closed: package count 3, staged 1")

    def test_closed_when_dates_differ(self, spark):
        lines = ["1, 7, 2024-01-01, 1, 1, Done", "2, 8, 2024-01-02, 1, 1, Done"]
        (row,) = self.gate(spark, control_of(spark, 1, 2), *lines).values()
        assert row["status"] == "C" and "start 2024-01-01, end 2024-01-02" in row["reason"]

    def test_closed_when_nothing_was_staged(self, spark):
        (row,) = self.gate(spark, control_of(spark, 1), "1, 8, 2024-01-01, 0, 1, Has ERROR").values()
        assert row["status"] == "C" and "start none" in row["reason"]

    def test_a_frontier_lasts_over_days_without_rows(self, spark):
        lines = [
            "1, 7, 2024-01-01, 1, 1, Done",
            "2, 8, 2024-01-01, 1, 1, Done, 2024-01-03",
            "1, 9, 2024-01-02, 1, 1, Done, 2024-01-04",
        ]
        got = self.gate(spark, control_of(spark, 1, 2), *lines, daily=True)
        assert {day: row["status"] for day, row in got.items()} == {
            "2024-01-01": "C", "2024-01-02": "C", "2024-01-03": "S", "2024-01-04": "C",
        }

    def test_only_dates_of_changes_are_worked_out(self, spark):
        """Years of days, two packages, three changes."""
        lines = [
            "1, 7, 2014-01-01, 1, 1, Done",
            "2, 8, 2014-01-01, 1, 1, Done",
            "1, 9, 2019-06-02, 1, 1, Done",
            "2, 10, 2024-01-03, 1, 1, Done",
            "2, 10, 2024-01-04, 0, 1, Has ERROR",
        ]
        control, log = control_of(spark, 1, 2), log_of(spark, *lines)
        got = self.gate(spark, control, *lines, daily=True)
        assert len(got) == 3656 and {row["package_count"] for row in got.values()} == {2}
        changes = gate._frontier_at_changes(gate._log_days(gate.of_suite(control, None).select("control_id", "suite_code"), log), gate._daily_successes(log))
        assert changes.count() == 2 * 3

    def test_the_last_outcome_of_a_day_decides(self, spark):
        lines = ["1, 7, 2024-01-01, 1, 1, Done", "1, 8, 2024-01-01, 0, 1, Has ERROR"]
        (row,) = self.gate(spark, control_of(spark, 1), *lines).values()
        assert row["status"] == "C"

    def test_the_gate_now_is_the_last_day_of_the_daily_gate(self, spark, events):
        control, log = derive.feed_control(events), derive.feed_log(events)
        now = readiness_gate(control, log)
        daily = readiness_gate(control, log, daily=True)
        last = daily.join(now.select("suite_code", "as_of"), ["suite_code", "as_of"], "left_semi")
        assert rows(now.select(last.columns)) == rows(last)
