"""Where the layers live: plain folders, or a lakehouse catalog when one is set up."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.control import staged_batches, summary_jobs
from tideline.sinks.files import delete, names
from tideline.sinks.keyed import KeyedTable
from tideline.sinks.landing import land_raw, month_windows, read_enriched, read_raw, run_name, write_enriched
from tideline.sinks.log import append_log, compact_log, log_state, read_log

# The layer names.
LAYERS = ("raw", "ext", "enrich")


class NoData(ValueError):
    """A table that nothing was written to yet."""


class Warehouse:
    """The tables of one installation, below one root path.

    ``buckets`` is the number of hash buckets that new ext tables get, see ``KeyedTable``.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"layer must be one of {LAYERS}, not {layer!r}")
        return f"{self.root}/{layer}/{name}"

    def raw(self, name: str, batches: DataFrame | None = None) -> DataFrame:
        """The landed rows of some batches, by default of all that the log says are done.

        Only the folders of their runs are listed.
        """
        if batches is None:
            batches = staged_batches(self.log_state())
        rows = read_raw(self.spark, self.path("raw", name), batches)
        if rows is None:
            raise NoData(f"the raw table {name!r} has no data yet")
        return rows

    def land(self, name: str, rows: DataFrame, windows: DataFrame) -> None:
        """Land the rows of some windows and log the windows as done.

        ``windows`` has ``control_id``, ``window_start``, ``window_end`` and ``job_id``. Landing a
        window again, by another job, replaces its batch, also by nothing.
        """
        started = datetime.now(timezone.utc).replace(tzinfo=None)
        land_raw(rows, self.path("raw", name), run_name(started))
        self._log_done("raw", name, windows, started)

    def ext(self, name: str, keys: Sequence[str], part_by: str | None = None) -> KeyedTable:
        return KeyedTable(self.spark, self.path("ext", name), keys, self.buckets, part_by)

    def enriched(self, name: str) -> DataFrame:
        jobs = summary_jobs(self.log_state(), name)
        rows = read_enriched(self.spark, self.path("enrich", name), jobs)
        if rows is None:
            raise NoData(f"the enrich table {name!r} has no data yet")
        return rows

    def write_enriched(self, name: str, rows: DataFrame, job_id: int, from_key: str, to_key: str) -> None:
        """Replace the months ``from_key`` to ``to_key`` of a summary table.

        Rows are tagged with the job that wrote them. A month in the range that has no rows any
        more is empty then; months outside it are not touched.
        """
        started = datetime.now(timezone.utc).replace(tzinfo=None)
        job = F.lit(job_id).cast("long")
        write_enriched(rows.withColumn("summary_job_id", job), self.path("enrich", name), run_name(started))
        months = month_windows(self.spark, from_key, to_key)
        self._log_done("enrich", name, months.withColumns({"control_id": F.lit(-1), "job_id": job}), started)

    def vacuum(self, layer: str, name: str, older: timedelta = timedelta(days=7)) -> int:
        """Delete the folders of runs of a raw or enrich table of which no row counts any more; how many.

        Only runs that began longer ago than ``older`` go, which has to be longer than any run or read takes.
        """
        log = self.log_state()
        jobs = staged_batches(log) if layer == "raw" else summary_jobs(log, name)
        # A row per run that still counts.
        alive = {run_name(r["start_time"]) for r in jobs.where("start_time is not null").select("start_time").distinct().collect()}
        until = run_name(datetime.now(timezone.utc).replace(tzinfo=None) - older)
        data = f"{self.path(layer, name)}/data"
        gone = [f for f in names(self.spark, data) if f.removeprefix("run=") not in alive and f.removeprefix("run=") < until]
        for folder in gone:
            delete(self.spark, f"{data}/{folder}")
        return len(gone)

    def _log_done(self, layer: str, name: str, windows: DataFrame, started: datetime) -> None:
        done = {"log_id": 2, "success_flag": 1, "complete_flag": 1, "layer": layer, "package_name": name}
        # After the write: of several jobs of a window the last one counts.
        moments = {"log_time": datetime.now(timezone.utc).replace(tzinfo=None), "start_time": started}
        values = {k: F.lit(v) for k, v in done.items()}
        values |= {k: F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz") for k, v in moments.items()}
        self.append_log(windows.withColumns(values))

    def log(self) -> DataFrame:
        """All log rows."""
        return read_log(self.spark, f"{self.root}/log")

    def log_state(self) -> DataFrame:
        """The log rows that flows decide by, see ``sinks.log``."""
        return log_state(self.spark, f"{self.root}/log")

    def compact_log(self, appends: int = 64) -> bool:
        return compact_log(self.spark, f"{self.root}/log", appends)

    def append_log(self, rows: DataFrame | Iterable[Mapping[str, object]]) -> None:
        append_log(self.spark, f"{self.root}/log", rows)


def open_table(
    spark: SparkSession,
    layer: str,
    name: str,
    root: str,
    catalog: str | None = None,
    keys: Sequence[str] = (),
    part_by: str | None = None,
) -> DataFrame:
    """A layer's table: from ``catalog`` when that is configured, else below ``root``.

    A catalog is configured by ``spark.sql.catalog.<name>`` and its warehouse
    settings, as lakehouse formats document; their jar must be on the class path.
    """
    if catalog is not None:
        if spark.conf.get(f"spark.sql.catalog.{catalog}", None) is None:
            raise ValueError(f"no catalog {catalog!r}: spark.sql.catalog.{catalog} is not set")
        return spark.table(f"{catalog}.{layer}.{name}")
    warehouse = Warehouse(spark, root)
    if layer == "raw":
        return warehouse.raw(name)
    if layer == "ext":
        return warehouse.ext(name, keys, part_by).read()
    return warehouse.enriched(name)
