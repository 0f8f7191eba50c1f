"""The merge as a stream: the checkpoint takes the place of the log's watermark."""

from __future__ import annotations

from collections.abc import Sequence
from threading import Event

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tideline.sinks.keyed import KeyedTable


def stream_merge(
    stream: DataFrame,
    table: KeyedTable,
    order: Sequence[str],
    checkpoint: str,
    when: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Merge every micro-batch of ``stream``, take what is there, then stop.

    Spark may run a micro-batch again after a failure. The table skips a batch that it has
    committed; batches are named by the query's id, which the checkpoint keeps, so a replay is
    skipped and nothing else is: other streams, and the same one with a new checkpoint, have other
    ids. Micro-batches may hold older rows than the table does: unless ``when`` says otherwise, a
    matched row is updated only by a later one in the sense of ``order``, which makes the final
    state independent of how the rows were cut into batches and of reading them again.

    Such a micro-batch only appends a delta, so any number of streams may feed one table at a time.
    Nothing is compacted here: call ``table.compact()`` beside the streams or after them.
    """
    identity: list[str] = []
    known = Event()

    def apply(batch: DataFrame, batch_id: int) -> None:
        known.wait()
        table.merge(batch, order, when, batch=f"{identity[0]}:{batch_id}", latest=when is None)

    writer = stream.writeStream if name is None else stream.writeStream.queryName(name)
    query = (
        writer.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    # The id is known once the query has started, which may be after its first batch.
    identity.append(query.id)
    known.set()
    return query

