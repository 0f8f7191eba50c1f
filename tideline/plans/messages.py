"""The texts of log rows."""

# Message sources that existing monitoring of the log looks for.
STAGING_START = "Log Staging Manage Starting"
STAGING_COUNT = "Log Staging Manage Package Count: "
STAGING_PACKAGE_START = "Log Staging Execution Starting"
STAGING_ERROR = "Log Staging Manage Has ERROR: "
STAGING_END = "Log Staging Manage Has Been Completed"
EXTRACT_START = "Log Extract Manage Start"
EXTRACT_COUNT = "Log Extract Manage Package Count: "
EXTRACT_PACKAGE_START = "Log Extract Execution Starting"
EXTRACT_PACKAGE_DONE = "Log Extract Execution System Command Has Been Completed"
EXTRACT_PACKAGE_ERROR = "Log Extract Execution System Command Has ERROR"
EXTRACT_ERROR = "Log Extract Manage Exception Has ERROR"
EXTRACT_END = "Log Extract Manage Has Been Completed"
SUMMARY_START = "Log Summary Manage Start"
SUMMARY_COUNT = "Log Summary Manage Package Count: "
SUMMARY_PACKAGE_START = "Log Summary Execution Starting"
SUMMARY_PACKAGE_CLOSED = "Log Summary Execution Has Been Completed"
SUMMARY_ERROR = "Log Summary Manage Exception ERROR: "
SUMMARY_END = "Log Summary Manage Has Been Completed"
EMPTY_LIST = "Package List Empty"

# Our own texts, where the log had none or one with the table's name inside.
STAGING_PACKAGE_CLOSED = "Log Staging Execution Has Closed"
STAGING_PACKAGE_DONE = "Log Staging Execution Has Been Completed"
STAGING_PACKAGE_ERROR = "Log Staging Execution Has ERROR: "
EXTRACT_PACKAGE_CLOSED = "Log Extract Execution Has Closed"
EXTRACT_BATCH_DONE = "Log Extract Execution Batch Has Been Completed"
SUMMARY_PACKAGE_DONE = "Log Summary Execution Enrich Completed"
SUMMARY_PACKAGE_ERROR = "Log Summary Execution Has ERROR: "
NO_PACKAGE = "Has Closed: the suite requires no package"
