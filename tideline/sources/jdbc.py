"""Window reads from source databases, in parallel slices of the window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.sources.windows import window_read

# The source types of the control table and their JDBC drivers.
DRIVERS = {
    "OLEDB_ORACLE": "oracle.jdbc.OracleDriver",
    "OLEDB": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
}


def jdbc_options(
    source_type: str,
    url: str,
    table: str,
    ts_col: str,
    start: object,
    end: object,
    partition_col: str | None = None,
    bounds: tuple[object, object] | None = None,
    slices: int = 8,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for one window of one table.

    The read is cut into ``slices`` ranges of ``partition_col``. Without one, the
    window's own time column and bounds are used, so every slice reads its share
    of just this window. An unknown source type is an error.
    """
    if source_type not in DRIVERS:
        raise ValueError(f"unknown source type {source_type!r}; known: {sorted(DRIVERS)}")
    if (partition_col is None) != (bounds is None):
        raise ValueError("partition_col and bounds go together")
    lower, upper = bounds if bounds is not None else (start, end)
    return {
        "driver": DRIVERS[source_type],
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_col or ts_col,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(slices),
        "fetchsize": str(fetch_size),
        "pushDownPredicate": "true",
        "preferTimestampNTZ": "true",
    }


def jdbc_window_read(
    spark: SparkSession,
    source_type: str,
    url: str,
    table: str,
    ts_col: str,
    start: object,
    end: object,
    **options: object,
) -> DataFrame:
    """Rows of one window of a database table; the window is filtered in the database."""
    chosen = jdbc_options(source_type, url, table, ts_col, start, end, **options)
    df = spark.read.format("jdbc").options(**chosen).load()
    return window_read(df, ts_col, start, end)
