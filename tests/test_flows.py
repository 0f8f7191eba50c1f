from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks import derive
from checks.queries import summaries
from tests.conftest import plan, rows
from tideline.functions import materialize
from tideline.operators import dedupe_latest, landed_counts, latest_status, log_errors, watermarks
from tideline.plans import enrich, run_extract, run_staging, run_summary
from tideline.session import scratch_path
from tideline.sinks import KeyedTable
from tideline.sources import Warehouse, window_read

STEP = timedelta(days=10)
START, AS_OF = "2024-01-01", "2024-01-31"


@pytest.fixture(scope="module")
def control(spark, events):
    base = derive.feed_control(events).unionByName(derive.ext_control(spark))
    return materialize(base, "control")


def new(spark) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, "warehouse"), buckets=4)


def stage(warehouse, control, events, **other):
    sources = {"events": derive.with_feed(events)}
    options = {"step": STEP, "default_start": START, "as_of": AS_OF, **other}
    return run_staging(warehouse, control, sources, **options)


def status(log):
    return {(r["control_id"], r["status"]) for r in latest_status(log).collect()}


class TestStaging:
    def test_runs_tile_the_source_and_stop_when_nothing_is_due(self, spark, events, control):
        warehouse = new(spark)
        for _ in range(3):
            log = stage(warehouse, control, events)
            assert {s for _, s in status(log)} == {"completed"}
        assert warehouse.raw("events").count() == events.count()
        lists = log.where("message_source = 'Log Staging Manage Package Count: 3'")
        assert {r["message"] for r in lists.collect()} == {
            f"List Of Staging Control ID: [{i},{i + 4},{i + 8}]" for i in range(4)
        }
        idle = stage(warehouse, control, events)
        assert idle.where("message = 'Package List Empty'").count() == 1
        assert idle.where("message_source like '%Has Closed%'").count() == derive.FEEDS
        assert status(idle) == set()
        assert warehouse.raw("events").count() == events.count()
        inserted = warehouse.log().where("complete_flag = 1").agg(F.sum("row_inserted")).first()[0]
        assert inserted == events.count()

    def test_a_crash_between_landing_and_logging_repeats_the_window(
        self, spark, events, control
    ):
        warehouse = new(spark)
        write = warehouse.append_log

        def crash(part):
            if not isinstance(part, list) and not part.where("complete_flag = 1").isEmpty():
                raise KeyboardInterrupt
            write(part)

        warehouse.append_log = crash
        with pytest.raises(KeyboardInterrupt):
            stage(warehouse, control, events)
        # Landed, but not logged: it does not count.
        assert warehouse.raw("events").isEmpty()
        assert watermarks(warehouse.log()).isEmpty()
        warehouse.append_log = write
        stage(warehouse, control, events)
        want = window_read(events, "ts", START, "2024-01-11")
        assert warehouse.raw("events").count() == want.count()

    def test_one_bad_package_does_not_stop_the_others(self, spark, events, control):
        warehouse = new(spark)
        # One feed's rows cannot be cast, which breaks the shared pass over the source.
        columns = ["*", "cast(if(feed_id = 3, event_type, '1') as int) as checked"]
        broken = control.where("layer = 'raw'").withColumn(
            "source_columns", F.array(*[F.lit(c) for c in columns])
        )
        log = stage(warehouse, broken, events)
        got = status(log)
        assert {c for c, s in got if s == "error"} == {3}
        assert {c for c, s in got if s == "completed"} == set(range(12)) - {3}
        assert "CAST_INVALID_INPUT" in log_errors(log).first()["message"]
        landed = {r[0] for r in watermarks(warehouse.log()).select("control_id").collect()}
        assert 3 not in landed and len(landed) == 11
        # The repaired package catches up from where it stood, the others go on.
        stage(warehouse, control, events)
        starts = {
            (r["control_id"], str(r["window_start"]))
            for r in landed_counts(warehouse.raw("events"), "ts").collect()
        }
        assert (3, "2024-01-01 00:00:00") in starts and (3, "2024-01-11 00:00:00") not in starts
        assert (2, "2024-01-11 00:00:00") in starts

    def test_unknown_source_types_and_missing_sources_are_logged(self, spark, events):
        warehouse = new(spark)
        base = derive.feed_control(events)
        odd = base.where("control_id = 0").withColumn("source_type", F.lit("ODBC"))
        gone = base.where("control_id = 1").withColumn("source_table", F.lit("gone"))
        log = stage(warehouse, odd.union(gone).union(base.where("control_id = 2")), events)
        assert status(log) == {(0, "error"), (1, "error"), (2, "completed")}

    def test_a_package_may_have_its_source_to_itself(self, spark, events):
        warehouse = new(spark)
        own = derive.feed_control(events).where("control_id = 4").withColumn(
            "source_key", F.lit(None).cast("string")
        )
        opened = []

        def source(first, last):
            opened.append((first, last))
            return window_read(derive.with_feed(events), "ts", first, last)

        run_staging(warehouse, own, {"events": source}, STEP, START, AS_OF)
        assert opened == [("2024-01-01 00:00:00", "2024-01-11 00:00:00")]
        want = window_read(events, "ts", START, "2024-01-11").count()
        assert warehouse.raw("events").count() == want
        assert warehouse.log().where("complete_flag = 1").first()["row_inserted"] == want

    def test_a_package_that_lags_gets_a_pass_of_its_own(self, spark, events, monkeypatch):
        from tideline.plans import staging

        warehouse, step = new(spark), timedelta(days=2)
        base = derive.feed_control(events)
        broken = base.withColumn("source_columns", F.array(F.lit("*"), F.lit("cast(if(feed_id = 3, event_type, '1') as int) as c")))
        for i in range(4):
            stage(warehouse, broken if i else base, events, step=step)
        spans = []
        read = staging.due_window_read

        def spy(source, windows, key, ts, span):
            spans.append((str(span.first)[:10], str(span.last)[:10]))
            return read(source, windows, key, ts, span)

        monkeypatch.setattr(staging, "due_window_read", spy)
        stage(warehouse, base, events, step=step)
        assert sorted(spans) == [("2024-01-03", "2024-01-05"), ("2024-01-09", "2024-01-11")]

    def test_a_run_that_fails_itself_is_logged(self, spark, events, control):
        warehouse = new(spark)
        with pytest.raises(Exception, match="nowhen"):
            stage(warehouse, control, events, as_of="nowhen")
        with pytest.raises(Exception):
            run_extract(warehouse, spark.range(1))
        with pytest.raises(Exception):
            run_summary(warehouse, spark.range(1), {})
        failed = {(r["layer"], r["job_id"], r["complete_flag"]) for r in log_errors(warehouse.log()).collect()}
        assert failed == {("raw", -1, 0), ("ext", -1, 0), ("enrich", -1, 0)}

    def test_only_the_suite_asked_for_runs(self, spark, events, control):
        log = stage(new(spark), control, events, suite=" T1 ")
        assert {c for c, _ in status(log)} == {1, 5, 9}

    def test_an_empty_window_is_completed_with_no_rows(self, spark, events, control):
        warehouse = new(spark)
        log = stage(warehouse, control, events, default_start="2020-01-01")
        assert {s for _, s in status(log)} == {"completed"}
        assert log.where("complete_flag = 1").agg(F.sum("row_inserted")).first()[0] == 0


class TestExtract:
    def test_state_follows_the_staged_batches(self, spark, events, control):
        warehouse = new(spark)
        for upto in ("2024-01-11", "2024-01-21", "2024-01-31"):
            stage(warehouse, control, events)
            run_extract(warehouse, control)
            seen = window_read(events, "ts", START, upto)
            want = dedupe_latest(seen, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id")
            state = warehouse.ext("user_latest", ["user_id"]).read()
            assert rows(state.select("user_id", "event_id")) == rows(want)
        idle = run_extract(warehouse, control)
        assert idle.where("message_source like '%Has Closed%'").count() == 3
        assert warehouse.ext("user_latest", ["user_id"]).version() == 3

    def test_a_failing_package_is_alone(self, spark, events, control):
        warehouse = new(spark)
        stage(warehouse, control, events)
        bad = F.when(F.col("package_name") == "user_record", "source.nothing > 1")
        broken = control.withColumn("merge_condition", bad)
        for version in (1, 2):
            log = run_extract(warehouse, broken)
            assert log_errors(log).select("package_name").distinct().collect() == [("user_record",)]
            assert warehouse.ext("user_latest", ["user_id"]).version() == version
            stage(warehouse, control, events)
        # Repaired, it merges the batches that it missed.
        run_extract(warehouse, control)
        right = new(spark)
        for _ in range(3):
            stage(right, control, events)
        run_extract(right, control)
        keys = ["user_id", "event_type"]
        assert rows(warehouse.ext("user_record", keys).read()) == rows(right.ext("user_record", keys).read())

    def test_the_state_does_not_depend_on_how_often_it_runs(self, spark, events, control):
        often, late = new(spark), new(spark)
        for _ in range(3):
            for warehouse in (often, late):
                stage(warehouse, control, events)
            run_extract(often, control)
        run_extract(late, control)
        keys = ["user_id", "event_type"]
        assert rows(often.ext("user_record", keys).read()) == rows(late.ext("user_record", keys).read())

    def test_one_package_in_two_suites(self, spark, events, control):
        warehouse = new(spark)
        other = control.where("package_name = 'user_latest'").withColumn("suite_code", F.lit("Y"))
        both = materialize(control.where("layer = 'raw' or package_name = 'user_latest'").unionByName(other), "control")
        stage(warehouse, both, events)
        log = run_extract(warehouse, both)
        jobs = latest_status(log).select("suite_code", "package_name", "status")
        assert rows(jobs) == [("X", "user_latest", "completed"), ("Y", "user_latest", "completed")]
        assert log_errors(log).isEmpty()

    def test_nothing_staged_is_closed(self, spark, control):
        log = run_extract(new(spark), control)
        assert log.where("message_source like '%Has Closed%'").count() == 3


SQL = "select '$suite' as suite_code, count(*) as n from {events} where feed_suite = '$suite'"


class TestSummary:
    def test_ready_suites_run_once_and_the_others_write_nothing(self, spark, events, control):
        warehouse = new(spark)
        both = control.unionByName(derive.summary_control(spark, SQL))
        stage(warehouse, both, events, suite="T1")
        tables = {"events": derive.with_feed(events)}
        log = run_summary(warehouse, both, tables)
        # Nothing of the other suites was ever staged.
        others = {(1000 + i, "closed") for i in (0, 2, 3)}
        assert status(log) == {(1001, "completed")} | others
        assert warehouse.enriched("summary_T1").select("n").first()["n"] > 0
        with pytest.raises(ValueError, match="no data"):
            warehouse.enriched("summary_T2")
        again = run_summary(warehouse, both, tables)
        assert status(again) == others

    def test_a_date_is_due_again_when_its_batches_change(self, spark, events, control):
        warehouse = new(spark)
        both = control.unionByName(derive.summary_control(spark, SQL))
        stage(warehouse, both, events, suite="T1")
        tables = {"events": derive.with_feed(events)}
        run_summary(warehouse, both, tables, suite="T1")
        once = warehouse.enriched("summary_T1").first()["n"]
        assert run_summary(warehouse, both, tables, suite="T1").where("complete_flag = 1").isEmpty()
        # A batch is staged again.
        row = warehouse.log().where("layer = 'raw' and complete_flag = 1").limit(1)
        warehouse.append_log(row.withColumn("log_time", F.current_timestamp().cast("timestamp_ntz")))
        doubled = {"events": derive.with_feed(events.union(events))}
        again = run_summary(warehouse, both, doubled, suite="T1")
        assert again.where("complete_flag = 1").count() == 1
        assert warehouse.enriched("summary_T1").first()["n"] == 2 * once

    def test_closed_suites_are_logged_with_the_reason(self, spark, events, control):
        warehouse = new(spark)
        both = control.unionByName(derive.summary_control(spark, SQL))
        stage(warehouse, both, events, suite="T1")
        stage(warehouse, both.where("control_id <> 5"), events, suite="T1")
        orphan = both.where("control_id = 1001").withColumns(
            {"control_id": F.lit(2000).cast("long"), "suite_code": F.lit("T9")}
        )
        tables = {"events": derive.with_feed(events)}
        log = run_summary(warehouse, both.unionByName(orphan), tables)
        assert status(log) == {(c, "closed") for c in (1000, 1001, 1002, 1003, 2000)}
        assert "no package" in log.where("control_id = 2000").first()["message"]
        assert "staged 0" in log.where("control_id = 1002").first()["message"]
        assert "staged 3" in log.where("control_id = 1001").first()["message"]

    def test_a_failing_query_is_logged(self, spark, events, control):
        warehouse = new(spark)
        both = control.unionByName(derive.summary_control(spark, "select nothing from {events}"))
        stage(warehouse, both, events)
        log = run_summary(warehouse, both, {"events": derive.with_feed(events)})
        assert status(log) == {(1000 + i, "error") for i in range(4)}


RUNS_SQL = """
select r.job_id, '$suite' as suite_code, count(*) as n
from {events} e join {runs} r on cast(e.ts as date) between r.start_date and r.end_date
where feed_suite = '$suite' and e.ts >= cast(:start as date) and e.ts < date_add(cast(:end as date), 1)
group by r.job_id
"""
ONE_SQL = """
select '$suite' as suite_code, count(*) as n from {events}
where feed_suite = '$suite' and ts >= cast(:start as date) and ts < date_add(cast(:end as date), 1)
having count(*) > 0
"""


def test_all_dates_by_one_plan(spark, events, monkeypatch):
    """SQL that names the runs gives what SQL for one date gives, and scans its input once."""
    from tideline.plans import summary

    got, scans = {}, {"runs": [], "one": []}
    write = summary.write_enriched
    monkeypatch.setattr(summary, "write_enriched", lambda df, *rest: scans[name].append(plan(df).count(") Scan parquet")) or write(df, *rest))
    for name, sql in (("runs", RUNS_SQL), ("one", ONE_SQL)):
        warehouse = new(spark)
        both = materialize(derive.feed_control(events).unionByName(derive.summary_control(spark, sql)), "control")
        stored = materialize(derive.with_feed(events), "events")
        log = run_summary(warehouse, both, {"events": stored}, log=derive.feed_log(events), daily=True)
        assert log_errors(log).select("message").collect() == []
        got[name] = rows(summaries(warehouse).select("partition_key", "summary_date", "suite_code", "n"))
    assert got["runs"] == got["one"]
    assert len(got["one"]) > 3
    assert max(scans["runs"]) == 1 < max(scans["one"])


@pytest.mark.parametrize("sql, n", [(RUNS_SQL, 6), (SQL, 60)])
def test_one_read_of_a_keyed_table_serves_all_packages(spark, monkeypatch, sql, n):
    events = spark.range(240).selectExpr(
        "id AS event_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id AS int)) AS ts",
        "id AS user_id",
        "'view' AS event_type",
        "cast(id AS double) AS value",
    )
    warehouse = new(spark)
    both = materialize(derive.feed_control(events).unionByName(derive.summary_control(spark, sql)), "control")
    stage(warehouse, both, events)
    table = warehouse.ext("by_month", ["partition_key", "event_id"], "partition_key")
    month = F.date_format("ts", "yyyyMM").alias("partition_key")
    for part in ("event_id < 200", "event_id >= 100"):
        table.merge(derive.with_feed(events).where(part).select("*", month), ["ts"])
    reads, read = [], KeyedTable.read
    monkeypatch.setattr(KeyedTable, "read", lambda t, *months: reads.append(months) or read(t, *months))
    log = run_summary(warehouse, both, {"events": table})
    assert status(log) == {(1000 + i, "completed") for i in range(4)}
    assert reads == [("202401", "202401")]
    assert rows(summaries(warehouse).select("suite_code", "n")) == [(f"T{i}", n) for i in range(4)]


def test_enrichment_parameters_are_bound(spark, events):
    sql = "select :start as a, :end as b, :job_id as j, :from_key as f, :to_key as t, count(*) n from {e}"
    got = enrich(spark, sql, datetime(2024, 1, 1), "it's", 5, "202401", "202402", {"e": events})
    assert rows(got) == [("2024-01-01 00:00:00", "it's", 5, "202401", "202402", events.count())]
