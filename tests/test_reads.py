from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from checks import derive
from tests.conftest import plan, rows
from tideline.operators import due_packages, staged_batches
from tideline.sources import (
    due_window_read,
    jdbc_options,
    partition_range_read,
    project_columns,
    staged_batch_read,
    window_read,
)
from tideline.sources import windows as windows_module
from tideline.sources.windows import Span


def test_window_holds_its_start_and_not_its_end(spark):
    df = spark.sql(
        "select cast(ts as timestamp_ntz) ts from values ('2024-01-08 00:00:00'),"
        " ('2024-01-14 23:59:59.999999'), ('2024-01-15 00:00:00') as t(ts)"
    )
    got = [str(r["ts"]) for r in window_read(df, "ts", "2024-01-08", "2024-01-15").collect()]
    assert got == ["2024-01-08 00:00:00", "2024-01-14 23:59:59.999999"]


def test_tiled_windows_are_the_whole(events):
    week = timedelta(days=7)
    starts = [date(2024, 1, 1) + i * week for i in range(5)]
    ids = [r["event_id"] for s in starts for r in window_read(events, "ts", s, s + week).collect()]
    assert len(ids) == len(set(ids)) == events.count()


def test_window_bounds_reach_the_scan(events):
    text = plan(window_read(events, "ts", "2024-01-08", "2024-01-15").select("value"))
    assert "GreaterThanOrEqual(ts,2024-01-08T00:00)" in text
    assert "LessThan(ts,2024-01-15T00:00)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in text


def _windows(events):
    log = derive.user_log(events)
    due = due_packages(derive.user_control(log), log, timedelta(days=7), "2024-01-01")
    return due.select("control_id", "window_start", "window_end")


def test_due_windows_are_the_same_broadcast_or_shuffled(events):
    windows = _windows(events)
    broadcast = due_window_read(events, windows, "user_id", "ts")
    shuffled = due_window_read(events, windows, "user_id", "ts", limit=0)
    assert "BroadcastHashJoin" in plan(broadcast)
    assert rows(broadcast) == rows(shuffled)
    assert broadcast.count() > 0


def test_due_window_bounds_reach_the_scan(events):
    assert "GreaterThanOrEqual(ts," in plan(due_window_read(events, _windows(events), "user_id", "ts"))


def test_source_columns_may_not_take_a_batch_column_s_name(events):
    with pytest.raises(ValueError, match=r"rename the source columns \['window_start'\]"):
        due_window_read(events.withColumn("window_start", F.col("ts")), _windows(events), "user_id", "ts")


def test_no_window_is_due(events):
    none = _windows(events).where(F.lit(False))
    assert due_window_read(events, none, "user_id", "ts").count() == 0


def test_a_hot_package_is_read_whole_without_broadcast(spark):
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("package"),
        F.timestamp_seconds(1704067200 + F.col("id")).cast("timestamp_ntz").alias("ts"),
    )
    windows = hot.select(F.col("package").alias("control_id")).distinct().select(
        "control_id",
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("window_start"),
        F.expr("timestamp_ntz'2024-01-02 00:00:00'").alias("window_end"),
    )
    got = due_window_read(hot, windows, "package", "ts", limit=0)
    assert got.count() == 30000


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_windows_that_meet_in_bins(spark, kind, zone):
    """A third of the rows are of one package; windows are short, long, empty, touching and overlapping."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        minutes = F.make_interval(mins=F.col("id").cast("int"))
        # Both changes of the clocks are in it.
        stamps = spark.range(0, 12000, 1, 4).select(
            (F.lit("2024-03-29").cast("timestamp_ntz") + 26 * minutes).cast(kind).alias("ts"),
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5).alias("package"),
            "id",
        )
        bounds = [(0, "03-30", "04-02"), (1, "01-01", "12-31"), (2, "03-31", "03-31"), (3, "04-01", "04-01 00:00:00.000001")]
        bounds += [(7, f"{m:02d}-{d:02d}", f"{m:02d}-{d + 1:02d}") for m in range(3, 11) for d in range(1, 27)]
        bounds += [(7, "10-26", "10-29"), (7, "10-27 01:30:00", "10-27 03:30:00")]
        windows = spark.createDataFrame([(c, f"2024-{a}", f"2024-{b}", i) for i, (c, a, b) in enumerate(bounds)], "control_id long, a string, b string, job_id long")
        windows = windows.select("control_id", F.col("a").cast("timestamp_ntz").alias("window_start"), F.col("b").cast("timestamp_ntz").alias("window_end"), "job_id")
        small, binned = (due_window_read(stamps, windows, "package", "ts", limit=n) for n in (10**9, 0))
        assert "_bin" in plan(binned) and "BroadcastHashJoin" in plan(small)
        want = rows(small)
        assert rows(binned) == want and len(want) > 3000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bins_spread_a_hot_package(spark):
    rows_of = spark.range(30000).select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(mins=F.col("id").cast("int"))).alias("ts"), F.lit(1).alias("package"))
    days = spark.range(20).select(F.lit(1).alias("control_id"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(days=F.col("id").cast("int"))).alias("window_start"))
    windows = days.withColumn("window_end", F.col("window_start") + F.expr("interval 1 day"))
    source, due = windows_module._in_bins(rows_of, windows, "ts", Span("2024-01-01 00:00:00", "2024-01-21 00:00:00", 1, timedelta(days=1)))
    assert source.select("_bin").distinct().count() == 21 and due.count() <= 2 * 20
    assert source.groupBy("_bin").count().agg(F.max("count")).first()[0] == 1440


def test_only_completed_batches_are_read(events):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    raw = events.withColumns({"control_id": F.col("user_id"), "window_start": day})
    done = staged_batches(derive.user_log(events))
    got = staged_batch_read(raw, done)
    bought = raw.where("event_type = 'purchase'").select("user_id", "window_start").distinct()
    assert got.count() == raw.join(bought, ["user_id", "window_start"]).count() > 0


def test_partition_range_holds_both_ends_and_prunes(spark, sf, tmp_path):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    path = str(tmp_path / "orders")
    month = F.concat(F.lit("m"), F.date_format("o_orderdate", "yyyyMM"))
    orders.withColumn("partition_key", month).write.partitionBy("partition_key").parquet(path)
    got = partition_range_read(spark.read.parquet(path), "m199601", "m199603")
    assert {r[0] for r in got.select("partition_key").distinct().collect()} == {
        "m199601", "m199602", "m199603",
    }
    assert "PartitionFilters: [isnotnull(partition_key" in plan(got)


def test_projection_takes_expressions_and_none_means_all(events):
    assert project_columns(events, ["event_id", "value * 2 AS double"]).columns == ["event_id", "double"]
    assert project_columns(events, None).columns == events.columns


def test_jdbc_slices_the_window_itself():
    options = jdbc_options("OLEDB_ORACLE", "jdbc:x", "S.T", "CHANGED", "2024-01-01", "2024-01-08", slices=4)
    assert options["driver"] == "oracle.jdbc.OracleDriver"
    assert (options["partitionColumn"], options["numPartitions"]) == ("CHANGED", "4")
    assert (options["lowerBound"], options["upperBound"]) == ("2024-01-01", "2024-01-08")


def test_jdbc_takes_another_slicing_column():
    options = jdbc_options("OLEDB", "jdbc:x", "T", "ts", "a", "b", partition_col="id", bounds=(1, 99))
    assert options["driver"].endswith("SQLServerDriver")
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"]) == ("id", "1", "99")


def test_unknown_source_type_is_an_error():
    with pytest.raises(ValueError, match="unknown source type 'ODBC'"):
        jdbc_options("ODBC", "jdbc:x", "T", "ts", "a", "b")
    with pytest.raises(ValueError, match="go together"):
        jdbc_options("OLEDB", "jdbc:x", "T", "ts", "a", "b", partition_col="id")
