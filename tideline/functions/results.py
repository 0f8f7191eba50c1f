"""Classification of result messages and of log rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A message whose text before the first colon is one of these is an
# error, in exactly this case.
ERROR_PREFIXES = ("Error", "ERR")
# The words that mark a log row as a failure or as closed.
ERROR_MARK = "ERROR"
CLOSED_MARK = "Has Closed"
# In rows that log a merged batch (ours): they repeat the id of the job that staged it.
BATCH_MARK = "Batch Has Been Completed"


def result_class(message: Column) -> Column:
    """``error`` or ``complete``, from the text before the first colon.

    Null and the empty text are not errors.
    """
    prefix = F.split_part(message, F.lit(":"), F.lit(1))
    return F.when(prefix.isin(*ERROR_PREFIXES), "error").otherwise("complete")


def is_error_row(success_flag: Column, message_source: Column) -> Column:
    """A failed row by its flag, or by its text.

    Exception handlers write a success flag of 1, so the flag alone misses them.
    """
    by_flag = F.coalesce(success_flag == 0, F.lit(False))
    return by_flag | F.coalesce(message_source.contains(ERROR_MARK), F.lit(False))
