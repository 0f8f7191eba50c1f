from tideline.operators.control import (
    CONTROL_SCHEMA,
    due_packages,
    landed_counts,
    latest_status,
    log_errors,
    package_list,
    pending_batches,
    staged_batches,
    suite_rollup,
    summary_jobs,
    watermarks,
)
from tideline.operators.gate import readiness_gate
from tideline.operators.merge import dedupe_latest, merge, merge_into_table

__all__ = [
    "CONTROL_SCHEMA",
    "dedupe_latest",
    "due_packages",
    "landed_counts",
    "latest_status",
    "log_errors",
    "merge",
    "merge_into_table",
    "package_list",
    "pending_batches",
    "readiness_gate",
    "staged_batches",
    "suite_rollup",
    "summary_jobs",
    "watermarks",
]
