from tideline.functions.keys import partition_key, window_key
from tideline.functions.results import is_error_row, result_class
from tideline.functions.sizing import (
    BROADCAST_BYTES,
    materialize,
    materialize_measured,
    row_bytes,
)

__all__ = [
    "BROADCAST_BYTES",
    "is_error_row",
    "materialize",
    "materialize_measured",
    "partition_key",
    "result_class",
    "row_bytes",
    "window_key",
]
