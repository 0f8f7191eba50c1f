"""What the three flows share: job ids, log rows and running packages side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime, timezone
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.sinks.log import conform_log, log_rows
from tideline.sources.layers import Warehouse

# Rows of one run that share a log time are ordered by these.
STARTED, ENDED = 1, 2
# What the rows of a package bring to its log row.
PACKAGE_COLUMNS = (
    "package_name",
    "control_id",
    "job_id",
    "suite_code",
    "row_inserted",
    "window_start",
    "window_end",
    "next_start",
)
Item = TypeVar("Item")


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def new_job_id(started: datetime, *parts: Column) -> Column:
    """A job id that differs between runs, packages and windows and is never negative.

    It is a hash and not a counter: no task has to see all packages to number them.
    """
    run = F.lit(started.isoformat(timespec="microseconds"))
    return F.xxhash64(run, *parts).bitwiseAND(F.lit(2**63 - 1))


class RunLog:
    """The log rows of one run of one layer."""

    def __init__(self, warehouse: Warehouse, layer: str, suite: str | None):
        self.warehouse = warehouse
        self.layer = layer
        self.suite = suite
        self.started = now()

    def packages(
        self,
        rows: DataFrame,
        source: str | Column,
        message: Column | None = None,
        success: int = 1,
        complete: int = 0,
    ) -> DataFrame:
        """One log row per row of ``rows``, which brings the ids and window columns."""
        ids = [name for name in PACKAGE_COLUMNS if name in rows.columns]
        own = [
            f"{ENDED if complete else STARTED} as log_id",
            f"{_literal(now())} as log_time",
            f"'{self.layer}' as layer",
            f"{_literal(self.started)} as start_time",
            f"{success} as success_flag",
            f"{complete} as complete_flag",
        ]
        words = {
            "message_source": F.lit(source) if isinstance(source, str) else source,
            "message": F.lit("") if message is None else message,
        }
        return conform_log(rows.withColumns(words).selectExpr(*ids, *own, *words))

    def manager(self, source: str, message: str = "") -> dict[str, object]:
        """A log row about the run itself; it has no package and no job."""
        return {
            "log_id": STARTED,
            "log_time": now(),
            "layer": self.layer,
            "package_name": "",
            "control_id": -1,
            "job_id": -1,
            "start_time": self.started,
            "success_flag": 1,
            "complete_flag": 0,
            "message_source": source,
            "message": message,
            "suite_code": self.suite,
        }

    @contextmanager
    def guard(self, source: str) -> Iterator[None]:
        """Log what stops the run itself, then let it through."""
        try:
            yield
        except Exception as error:
            self.write(self.manager(source, f"ERR: {error}"))
            raise

    def write(self, *parts: DataFrame | dict[str, object]) -> None:
        """Append the rows of all parts by one job, in as few files as they need."""
        own = [part for part in parts if isinstance(part, dict)]
        frames = [part for part in parts if not isinstance(part, dict)]
        if own:
            frames.append(log_rows(self.warehouse.spark, own))
        rows = reduce(DataFrame.unionByName, frames)
        self.warehouse.append_log(rows.hint("rebalance") if len(frames) > 1 else rows)

    def rows(self) -> DataFrame:
        """The log rows that this run wrote; the log is compacted here, when it is time."""
        self.warehouse.compact_log()
        mine = f"layer = '{self.layer}' and start_time = {_literal(self.started)}"
        return self.warehouse.log().where(mine)


def _literal(moment: datetime) -> str:
    return f"timestamp_ntz'{moment.isoformat(sep=' ', timespec='microseconds')}'"


def side_by_side(
    spark: SparkSession, work: Callable[[Item], None], items: Iterable[Item], parallel: int
) -> None:
    """Run ``work`` for each item from a few threads, so that small packages share the cluster."""
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        # Job groups, pools and tags that the caller set hold in the threads as well.
        target = inheritable_thread_target(spark)(work)
        for done in [pool.submit(target, item) for item in items]:
            done.result()
