"""Columns that name a month or a window in a directory layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def partition_key(ts: Column) -> Column:
    """The month of a date or timestamp as ``yyyyMM``."""
    return F.date_format(ts, "yyyyMM")


def window_key(window_start: Column) -> Column:
    """A window start as a directory name.

    The leading letter keeps partition discovery from reading it as a number, and
    there is no character in it that a path would escape. Microseconds are part
    of it: two windows never share a directory.
    """
    return F.date_format(window_start, "'w'yyyyMMdd'T'HHmmssSSSSSS")
