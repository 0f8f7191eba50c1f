"""The registered queries: each takes the session and a test data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import derive, templates
from tideline.functions import materialize, partition_key, result_class
from tideline.operators import (
    dedupe_latest,
    due_packages,
    landed_counts,
    latest_status,
    log_errors,
    merge,
    package_list,
    readiness_gate,
    staged_batches,
    suite_rollup,
    watermarks,
)
from tideline.plans import enrich, run_extract, run_staging, run_summary
from tideline.session import scratch_path
from tideline.sinks import KeyedTable
from tideline.sources import (
    NoData,
    Warehouse,
    due_window_read,
    open_table,
    partition_range_read,
    project_columns,
    staged_batch_read,
    window_read,
)
from tideline.streaming import stream_merge

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

START = "2024-01-01"
WEEK = timedelta(days=7)
STEP = timedelta(days=10)
# The day the test merges are cut at: rows shipped before it are the target.
CUT = "1998-06-02"
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


def query(function: Query) -> Query:
    """Register a query by its name without the ``q_``, which keeps it apart from the operator."""
    QUERIES[function.__name__.removeprefix("q_")] = function
    return function


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.table(spark, sf_dir, "events")


def _warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, "warehouse"))


# -- reads


@query
def q_window_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table, read as the weekly windows that tile it."""
    events = _events(spark, sf_dir)
    starts = [date(2024, 1, 1) + i * WEEK for i in range(5)]
    reads = [
        window_read(events, "ts", start, start + WEEK).select(
            F.lit(str(start)).alias("window_start"), "*"
        )
        for start in starts
    ]
    return reduce(DataFrame.unionByName, reads)


@query
def q_due_window_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    windows = q_due_packages(spark, sf_dir).select("control_id", "window_start", "window_end")
    return due_window_read(events, windows, "user_id", "ts")


def _daily_batches(events: DataFrame) -> DataFrame:
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return events.withColumns({"control_id": F.col("user_id"), "window_start": day})


@query
def q_staged_batch_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return staged_batch_read(_daily_batches(events), staged_batches(derive.user_log(events)))


def _keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = derive.table(spark, sf_dir, "orders")
    return orders.withColumn("partition_key", partition_key(F.col("o_orderdate")))


@query
def q_partition_range_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _warehouse(spark)
    warehouse.write_enriched("orders", _keyed_orders(spark, sf_dir), 1, "199501", "200108")
    return partition_range_read(warehouse.enriched("orders"), "199601", "199912")


@query
def q_project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_columns(
        derive.table(spark, sf_dir, "lineitem"),
        [
            "l_orderkey",
            "l_linenumber AS line",
            "cast(round(l_extendedprice * 100) as bigint) AS price_cents",
            "upper(l_returnflag) || '-' || lower(l_linestatus) AS state",
        ],
    )


# -- sinks


def _feed_windows(events: DataFrame, job_base: int) -> DataFrame:
    """Every feed's windows over the month, with the job that lands each."""
    feeds = derive.feed_control(events).select("control_id")
    starts = F.sequence(
        F.lit(START).cast("timestamp_ntz"),
        F.lit("2024-01-21").cast("timestamp_ntz"),
        F.expr("interval 10 days"),
    )
    return feeds.select(
        "control_id",
        F.explode(starts).alias("window_start"),
        (F.col("control_id") + job_base).alias("job_id"),
    ).withColumn("window_end", F.col("window_start") + F.lit(STEP))


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events landed in windows per feed, twice by different jobs."""
    warehouse = _warehouse(spark)
    events = _events(spark, sf_dir)
    for job_base in (100, 200):
        windows = _feed_windows(events, job_base)
        batch = due_window_read(derive.with_feed(events), windows, "feed_id", "ts")
        warehouse.land("events", batch, windows)
    return warehouse.raw("events")


@query
def q_land_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir).drop("window_key", "feed_id", "feed_suite")


@query
def q_landed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed_counts(_landed(spark, sf_dir), "ts")


@query
def q_write_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months written by job 1, then three of them again by job 2."""
    warehouse = _warehouse(spark)
    months = (
        _keyed_orders(spark, sf_dir)
        .groupBy("partition_key", "o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("price_cents"),
        )
    )
    warehouse.write_enriched("orders", months, 1, "199501", "200108")
    again = partition_range_read(months, "199601", "199603")
    warehouse.write_enriched("orders", again.withColumn("orders", -F.col("orders")), 2, "199601", "199603")
    return warehouse.enriched("orders")


@query
def q_append_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log written by two appends, as a run writes its begin and its end."""
    warehouse = _warehouse(spark)
    log = derive.user_log(_events(spark, sf_dir))
    for complete in (0, 1):
        warehouse.append_log(log.where(F.col("complete_flag") == complete))
    return warehouse.log()


@query
def q_open_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as an ext table, orders as an enrich table, opened by layer and name."""
    warehouse = _warehouse(spark)
    customers = derive.table(spark, sf_dir, "customer")
    warehouse.ext("customer", ["c_custkey"]).merge(customers, ["c_name"])
    orders = _keyed_orders(spark, sf_dir)
    warehouse.write_enriched("orders", orders, 1, "199501", "200108")
    stored = open_table(spark, "ext", "customer", warehouse.root, keys=["c_custkey"])
    by_month = open_table(spark, "enrich", "orders", warehouse.root)
    return by_month.join(stored, by_month.o_custkey == stored.c_custkey).select(
        "o_orderkey", "partition_key", "c_name", "c_mktsegment"
    )


# -- scalar expressions


@query
def q_partition_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_orders(spark, sf_dir).select("o_orderkey", "partition_key")


@query
def q_result_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = derive.user_log(_events(spark, sf_dir))
    return log.select("log_id", result_class(F.col("message")).alias("result"))


# -- merge


@query
def q_dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_latest(derive.table(spark, sf_dir, "lineitem"), LINE_KEYS, LINE_ORDER)


def _merge_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The whole lineitem table, as the state at the cut and what was shipped after it."""
    lines = derive.table(spark, sf_dir, "lineitem")
    target = window_read(lines, "l_shipdate", "1900-01-01", CUT)
    source = window_read(lines, "l_shipdate", CUT, "2100-01-01")
    return tuple(dedupe_latest(side, LINE_KEYS, LINE_ORDER) for side in (target, source))


@query
def q_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge(*_merge_sides(spark, sf_dir), LINE_KEYS)


@query
def q_merge_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    when = "source.l_extendedprice > target.l_extendedprice"
    return merge(*_merge_sides(spark, sf_dir), LINE_KEYS, when=when)


@query
def q_merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge(*_merge_sides(spark, sf_dir), LINE_KEYS, matched="ignore")


@query
def q_merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that is null in some rows: the source is merged twice, then inserted once more."""
    target, source = (
        side.withColumn("l_linenumber", F.expr("nullif(l_linenumber, 7)"))
        for side in _merge_sides(spark, sf_dir)
    )
    merged = merge(merge(target, source, LINE_KEYS), source, LINE_KEYS)
    return merge(merged, source, LINE_KEYS, matched="ignore")


@query
def q_merge_month_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders merged into a table partitioned by month, half of them twice."""
    orders = _keyed_orders(spark, sf_dir)
    path = scratch_path(spark, "orders-by-month")
    table = KeyedTable(spark, path, ["partition_key", "o_orderkey"], 2, "partition_key")
    order = ["o_orderdate", "o_totalprice"]
    table.merge(window_read(orders, "o_orderdate", "1900-01-01", CUT), order)
    late = window_read(orders, "o_orderdate", "1996-01-01", "2100-01-01")
    table.merge(late.withColumn("o_orderpriority", F.upper("o_orderpriority")), order)
    return table.read()


@query
def q_merge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three merges into a stored table: create, upsert, insert only."""
    lines = derive.table(spark, sf_dir, "lineitem")
    table = KeyedTable(spark, scratch_path(spark, "lines"), LINE_KEYS)
    bounds = ["1900-01-01", "1997-04-01", "1999-07-01", "2100-01-01"]
    for i, matched in enumerate(["update", "update", "ignore"]):
        part = window_read(lines, "l_shipdate", bounds[i], bounds[i + 1])
        table.merge(part, LINE_ORDER, matched=matched)
    return table.read()


# -- control and log


@query
def q_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermarks(derive.user_log(_events(spark, sf_dir)))


@query
def q_due_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = derive.user_log(_events(spark, sf_dir))
    return due_packages(derive.user_control(log), log, WEEK, START)


@query
def q_latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_status(derive.user_log(_events(spark, sf_dir)))


@query
def q_suite_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suite_rollup(derive.user_log(_events(spark, sf_dir)))


@query
def q_package_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return package_list(derive.feed_control(_events(spark, sf_dir)))


@query
def q_log_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = derive.user_log(_events(spark, sf_dir))
    return log_errors(log)


@query
def q_readiness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return readiness_gate(derive.feed_control(events), derive.feed_log(events), daily=True)


@query
def q_readiness_gate_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return readiness_gate(derive.feed_control(events), derive.feed_log(events))


# -- enrichment and flows


def _enrich(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    names = ("customer", "nation", "region")
    tables = {name: derive.table(spark, sf_dir, name) for name in names}
    tables["orders"] = _keyed_orders(spark, sf_dir)
    return enrich(spark, sql, "1995-01-01", "2001-09-01", 7, "199501", "200108", tables)


@query
def q_enrich_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enrich(spark, sf_dir, templates.ORDERS)


@query
def q_enrich_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enrich(spark, sf_dir, templates.MONTHLY)


def _stored(control: DataFrame) -> DataFrame:
    """The control table as an installation has it: stored, not derived at each use."""
    return materialize(control, "control")


def stage_month(
    warehouse: Warehouse, control: DataFrame, events: DataFrame, runs: int, each=lambda: None
) -> None:
    """Staging runs over the month of events, ten days each."""
    sources = {"events": derive.with_feed(events)}
    for _ in range(runs):
        run_staging(warehouse, control, sources, STEP, START, as_of="2024-01-31")
        each()


@query
def q_flow_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs cover the month; the fourth finds nothing due."""
    warehouse, events = _warehouse(spark), _events(spark, sf_dir)
    stage_month(warehouse, _stored(derive.feed_control(events)), events, runs=4)
    return landed_counts(warehouse.raw("events"), "ts")


def _extracted(spark: SparkSession, sf_dir: str, every: int) -> Warehouse:
    """The month staged in three runs, and merged after each or once at the end."""
    warehouse, events = _warehouse(spark), _events(spark, sf_dir)
    control = _stored(derive.feed_control(events).unionByName(derive.ext_control(spark)))
    runs = iter(range(1, 4))

    def each() -> None:
        if next(runs) % every == 0:
            run_extract(warehouse, control)

    stage_month(warehouse, control, events, 3, each)
    return warehouse


def _current(warehouse: Warehouse) -> DataFrame:
    """The three tables that the ext packages keep, under their names."""
    tables = {
        "user_latest": warehouse.ext("user_latest", ["user_id"]),
        "user_record": warehouse.ext("user_record", ["user_id", "event_type"]),
        "events_by_month": warehouse.ext(
            "events_by_month", ["partition_key", "event_id"], "partition_key"
        ),
    }
    named = [table.read().withColumn("package_name", F.lit(name)) for name, table in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


@query
def q_flow_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge run after each of the three staging runs, by three packages."""
    return _current(_extracted(spark, sf_dir, every=1))


@query
def q_flow_extract_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One merge run after the three staging runs: the same state."""
    return _current(_extracted(spark, sf_dir, every=3))


@query
def q_flow_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The jobs of a log that staging and merge runs wrote, counted by state."""
    status = latest_status(_extracted(spark, sf_dir, every=1).log())
    return status.groupBy("layer", "suite_code", "package_name", "status").agg(
        F.count(F.lit(1)).alias("jobs"), F.countDistinct("control_id").alias("packages")
    )


@query
def q_flow_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suite_rollup(_extracted(spark, sf_dir, every=1).log())


@query
def q_flow_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage, merge, summarise from the merged tables; then the last ten days come again, doubled."""
    warehouse, events = _warehouse(spark), _events(spark, sf_dir)
    control = _all_layers(spark, events)
    _through(spark, warehouse, control, events)
    last = F.lit("2024-01-21").cast("timestamp_ntz")
    changed = events.withColumn("value", F.when(F.col("ts") >= last, F.col("value") * 2).otherwise(F.col("value")))
    # Staged again by hand, by new jobs.
    again = _feed_windows(events, 300).where(F.col("window_start") == last)
    rows = due_window_read(derive.with_feed(changed), again, "feed_id", "ts")
    suites = derive.feed_control(events).select("control_id", "suite_code")
    warehouse.land("events", rows, again.join(suites, "control_id"))
    run_extract(warehouse, control)
    run_summary(warehouse, control, {"events": _by_month(warehouse)})
    return summaries(warehouse)


@query
def q_flow_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dates on which a suite was ever ready, by the log of the feeds."""
    warehouse, events = _warehouse(spark), _events(spark, sf_dir)
    control = derive.feed_control(events).unionByName(
        derive.summary_control(spark, templates.DAILY)
    )
    control = _stored(control)
    tables = {"events": derive.with_feed(events)}
    run_summary(warehouse, control, tables, log=derive.feed_log(events), daily=True)
    return summaries(warehouse)


def summaries(warehouse: Warehouse) -> DataFrame:
    """The summaries of all suites; a suite that was never ready has none."""
    parts = []
    for i in range(derive.SUITES):
        try:
            parts.append(warehouse.enriched(f"summary_T{i}"))
        except NoData:
            continue
    return reduce(DataFrame.unionByName, parts).drop("summary_job_id")


@query
def q_stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed batches as two streams of several micro-batches at the same time; both run again."""
    warehouse, events = _warehouse(spark), _events(spark, sf_dir)
    table = warehouse.ext("user_latest", ["user_id"])
    streams = {}
    for name, feeds in (("low", "control_id < 6"), ("high", "control_id >= 6")):
        windows = _feed_windows(events, 100).where(feeds)
        rows = due_window_read(derive.with_feed(events), windows, "feed_id", "ts")
        warehouse.land(name, rows, windows)
        streams[name] = (f"{warehouse.path('raw', name)}/data/*/*", warehouse.raw(name).schema)
    for _ in range(2):
        queries = []
        for name, (path, schema) in streams.items():
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 6).parquet(path)
            rows = stream.select("user_id", "ts", "event_id", "event_type", "value")
            checkpoint = f"{warehouse.root}/checkpoints/{name}"
            queries.append(stream_merge(rows, table, ["ts", "event_id"], checkpoint))
        for running in queries:
            running.awaitTermination()
        table.compact()
    return table.read()


def _all_layers(spark: SparkSession, events: DataFrame) -> DataFrame:
    return _stored(
        derive.feed_control(events)
        .unionByName(derive.ext_control(spark))
        .unionByName(derive.summary_control(spark, templates.DAILY))
    )


def _by_month(warehouse: Warehouse) -> KeyedTable:
    return warehouse.ext("events_by_month", ["partition_key", "event_id"], "partition_key")


def _through(
    spark: SparkSession, warehouse: Warehouse, control: DataFrame, events: DataFrame
) -> None:
    """All three layers in one go: stage, merge and summarise the month."""
    stage_month(warehouse, control, events, 3, each=lambda: run_extract(warehouse, control))
    run_summary(warehouse, control, {"events": _by_month(warehouse)})


def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three layers in one go: stage, merge and summarise the month."""
    warehouse, events = _warehouse(spark), _events(spark, sf_dir)
    _through(spark, warehouse, _all_layers(spark, events), events)
    return summaries(warehouse)
