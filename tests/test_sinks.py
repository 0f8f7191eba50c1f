from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import derive
from tests.conftest import plan, rows
from tideline.operators import latest_status, readiness_gate, staged_batches, suite_rollup, watermarks
from tideline.sinks import LOG_SCHEMA, append_log, compact_log, land_raw, landing, log_state, read_log, run_name
from tideline.sinks.landing import audited
from tideline.sources import NoData, Warehouse, open_table, window_read

DAY, NEXT = ("2024-01-01", "2024-01-02"), ("2024-01-02", "2024-01-03")


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path))


def land(warehouse, rows_, job, control, window):
    """One window of one package, landed and logged."""
    batch = warehouse.spark.range(1).select()
    warehouse.land("events", audited(rows_, job, control, *window), audited(batch, job, control, *window))


def raw_jobs(warehouse):
    got = warehouse.raw("events").groupBy("control_id", "job_id").count()
    return {(r["control_id"], r["job_id"]): r["count"] for r in got.collect()}


def test_landing_a_window_again_replaces_it(spark, events, warehouse):
    first, second = window_read(events, "ts", *DAY), window_read(events, "ts", *NEXT)
    land(warehouse, first, 1, 5, DAY)
    land(warehouse, second, 2, 5, NEXT)
    views = first.where("event_type = 'view'")
    land(warehouse, views, 3, 5, DAY)
    assert raw_jobs(warehouse) == {(5, 2): second.count(), (5, 3): views.count()}


def test_a_window_that_comes_back_empty_empties_its_batch(spark, events, warehouse):
    day = window_read(events, "ts", *DAY)
    land(warehouse, day, 1, 5, DAY)
    land(warehouse, day, 2, 6, DAY)
    land(warehouse, day.where("false"), 3, 5, DAY)
    assert raw_jobs(warehouse) == {(6, 2): day.count()}


def test_an_empty_first_window_lands_nothing(spark, events, warehouse):
    land(warehouse, events.where("false"), 1, 5, DAY)
    assert warehouse.raw("events").isEmpty()
    assert set(events.columns) < set(warehouse.raw("events").columns)


def test_a_rerun_that_is_half_written_is_not_seen(spark, events, warehouse):
    """Its rows are there, even whole files; the log does not have its jobs yet."""
    day = window_read(events, "ts", *DAY)
    land(warehouse, day, 1, 5, DAY)
    open_before = warehouse.raw("events")
    path = warehouse.path("raw", "events")
    land_raw(audited(day.where("event_type = 'view'"), 2, 5, *DAY), path, run_name(datetime.now()))
    assert raw_jobs(warehouse) == {(5, 1): day.count()}
    land(warehouse, day.where("event_type = 'click'"), 3, 5, DAY)
    assert raw_jobs(warehouse) == {(5, 3): day.where("event_type = 'click'").count()}
    # A reader that began before the rerun goes on reading what it began with.
    assert open_before.count() == day.count()


def test_replaced_runs_are_deleted_in_time(spark, events, warehouse):
    day = window_read(events, "ts", *DAY)
    for job in (1, 2):
        land(warehouse, day, job, 5, DAY)
        warehouse.write_enriched("s", spark.sql("select '202401' as partition_key, 1 as n"), job, "202401", "202401")
    land(warehouse, day, 3, 6, DAY)
    for layer, name in (("raw", "events"), ("enrich", "s")):
        assert warehouse.vacuum(layer, name) == 0
        assert warehouse.vacuum(layer, name, timedelta(seconds=-5)) == 1
    assert raw_jobs(warehouse) == {(5, 2): day.count(), (6, 3): day.count()}
    assert rows(warehouse.enriched("s").select("summary_job_id")) == [(2,)]


def test_pending_batches_are_read_from_their_folders_only(spark, events, warehouse, monkeypatch):
    """Thousands of old batches in hundreds of runs: two are listed."""
    day = window_read(events, "ts", *DAY)
    old = Path(warehouse.path("raw", "events")) / "data"
    for i in range(300):
        (old / f"run=2020010{i % 9}T{i:012d}" / "pass=x").mkdir(parents=True)
    land(warehouse, day, 1, 5, DAY)
    land(warehouse, day, 2, 5, NEXT)
    land(warehouse, day, 3, 6, NEXT)
    pending = staged_batches(warehouse.log_state()).where("job_id < 3")
    listed = []
    monkeypatch.setattr(landing, "_read", lambda s, folders, schema: listed.extend(folders) or spark.createDataFrame([], schema))
    assert warehouse.raw("events", pending).isEmpty()
    assert len(listed) == 2 and all("/run=20" in f and "run=2020" not in f for f in listed)


def test_columns_may_come_and_go(spark, events, warehouse):
    day = window_read(events, "ts", *DAY)
    land(warehouse, day.withColumn("more", F.lit(1)), 1, 5, DAY)
    land(warehouse, day.drop("props"), 2, 5, NEXT)
    got = warehouse.raw("events")
    assert got.where("more = 1 and props is not null").count() == got.where("more is null and props is null").count() == day.count()
    with pytest.raises(ValueError, match="'more' in two types"):
        land(warehouse, day.withColumn("more", F.lit("x")), 3, 5, DAY)
        warehouse.raw("events")


def test_a_hot_batch_is_written_by_several_tasks(spark, warehouse):
    wide = spark.range(40000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
    keys = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"]
    before = [spark.conf.get(key) for key in keys]
    try:
        spark.conf.set(keys[0], "1MB")
        land(warehouse, wide, 1, 5, DAY)
    finally:
        for key, value in zip(keys, before):
            spark.conf.set(key, value)
    batch = warehouse.raw("events")
    assert batch.count() == 40000 and len(batch.inputFiles()) > 1


def test_months_outside_the_range_keep_their_rows(spark, warehouse):
    months = ["202312", "202401", "202402"]
    keys = F.explode(F.array(*[F.lit(m) for m in months])).alias("partition_key")
    table = spark.range(1).select(keys).withColumn("n", F.lit(1))
    warehouse.write_enriched("s", table, 1, "202312", "202402")
    again = table.where("partition_key = '202401'").withColumn("n", F.lit(2))
    warehouse.write_enriched("s", again, 2, "202401", "202402")
    # February was in the range of the second job and had no rows.
    got = warehouse.enriched("s")
    assert rows(got.select("partition_key", "n", "summary_job_id")) == [("202312", 1, 1), ("202401", 2, 2)]
    text = plan(got.where("partition_key = '202401'"))
    assert "partition_key" in text.split("PartitionFilters:")[1].split("\n")[0]


def test_log_rows_are_typed_and_stored_as_given(spark, tmp_path):
    path = str(tmp_path / "log")
    text = "it's 'quoted'; -- and \"so\" on"
    append_log(spark, path, [{"log_id": 1, "message": text, "log_time": datetime(2024, 1, 1, 1, 2, 3, 4)}])
    append_log(spark, path, spark.sql("select 2 as log_id, 'x' as message"))
    log = read_log(spark, path)
    assert log.schema == LOG_SCHEMA
    assert [(r["log_id"], r["message"]) for r in log.orderBy("log_id").collect()] == [(1, text), (2, "x")]
    assert log.where("log_id = 1").first()["log_time"] == datetime(2024, 1, 1, 1, 2, 3, 4)


class TestWarehouse:
    def test_tables_are_opened_by_layer(self, spark, events, tmp_path):
        warehouse = Warehouse(spark, str(tmp_path))
        land(warehouse, window_read(events, "ts", *DAY), 1, 5, DAY)
        warehouse.ext("users", ["user_id"]).merge(events.select("user_id", "ts"), ["ts"])
        enriched = spark.sql("select '202401' as partition_key, 1 as n")
        warehouse.write_enriched("s", enriched, 1, "202401", "202401")
        root = str(tmp_path)
        assert dict(open_table(spark, "raw", "events", root).dtypes)["control_id"] == "bigint"
        assert open_table(spark, "ext", "users", root, keys=["user_id"]).count() == 15
        assert dict(open_table(spark, "enrich", "s", root).dtypes)["partition_key"] == "string"

    def test_what_is_not_there_is_said(self, spark, tmp_path):
        warehouse = Warehouse(spark, str(tmp_path))
        with pytest.raises(NoData, match="raw table 'x'"):
            warehouse.raw("x")
        with pytest.raises(ValueError, match="layer must be"):
            warehouse.path("gold", "x")
        with pytest.raises(ValueError, match="nothing was merged"):
            warehouse.ext("x", ["k"]).read()
        with pytest.raises(ValueError, match="no catalog 'lake'"):
            open_table(spark, "ext", "x", str(tmp_path), catalog="lake")
        assert warehouse.log().isEmpty()


def test_appends_of_many_warehouses_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    def appends(job):
        for i in range(5):
            Warehouse(spark, str(tmp_path)).append_log([{"job_id": job, "log_id": i}])
            Warehouse(spark, str(tmp_path)).compact_log(appends=3)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(appends, range(4)))
    got = rows(Warehouse(spark, str(tmp_path)).log().select("job_id", "log_id"))
    assert got == [(job, i) for job in range(4) for i in range(5)]


def test_the_log_answers_the_same_before_and_after_compaction(spark, events, tmp_path):
    log, path = derive.feed_log(events), str(tmp_path)
    control = derive.feed_control(events)
    answers = {
        "watermarks": watermarks,
        "staged": lambda l: staged_batches(l).drop("start_time"),
        "status": latest_status,
        "rollup": suite_rollup,
        "gate": lambda l: readiness_gate(control, l),
        "gate_daily": lambda l: readiness_gate(control, l, daily=True),
    }
    want = {name: rows(answer(log)) for name, answer in answers.items()}
    files = []
    for i in range(12):
        append_log(spark, path, log.where(F.col("log_id") % 12 == i).coalesce(1))
        compact_log(spark, path, appends=3, keep=timedelta(0))
        files.append(len(log_state(spark, path).inputFiles()))
    assert {name: rows(answer(log_state(spark, path))) for name, answer in answers.items()} == want
    assert rows(read_log(spark, path)) == rows(log)
    # What a run reads does not grow with the number of earlier runs.
    assert max(files) <= 4 and log_state(spark, path).count() < log.count()
    assert len(list((tmp_path / "appends").iterdir())) <= 6
