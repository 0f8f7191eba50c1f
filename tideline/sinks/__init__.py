from tideline.sinks.keyed import KeyedTable
from tideline.sinks.landing import land_raw, read_enriched, read_raw, run_name, write_enriched
from tideline.sinks.log import LOG_SCHEMA, append_log, compact_log, conform_log, log_state, read_log

__all__ = [
    "KeyedTable",
    "LOG_SCHEMA",
    "append_log",
    "compact_log",
    "conform_log",
    "land_raw",
    "log_state",
    "read_enriched",
    "read_log",
    "read_raw",
    "run_name",
    "write_enriched",
]
