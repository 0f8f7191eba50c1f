from tideline.sources.jdbc import jdbc_options, jdbc_window_read
from tideline.sources.layers import NoData, Warehouse, open_table
from tideline.sources.windows import (
    Span,
    due_window_read,
    partition_range_read,
    project_columns,
    staged_batch_read,
    window_read,
)

__all__ = [
    "NoData",
    "Span",
    "Warehouse",
    "due_window_read",
    "jdbc_options",
    "jdbc_window_read",
    "open_table",
    "partition_range_read",
    "project_columns",
    "staged_batch_read",
    "window_read",
]
