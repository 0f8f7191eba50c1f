from __future__ import annotations

from tests.conftest import rows
from tideline.operators import dedupe_latest
from tideline.session import scratch_path
from tideline.sinks import KeyedTable
from tideline.streaming import stream_merge

ORDER = ["ts", "event_id"]


def run(spark, source, table, checkpoint, **options):
    stream = spark.readStream.schema(spark.read.parquet(source).schema)
    rows = stream.option("maxFilesPerTrigger", 1).parquet(source)
    stream_merge(rows, table, ORDER, checkpoint, **options).awaitTermination()


def test_micro_batches_in_any_order_give_the_batch_answer(spark, events, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    table = KeyedTable(spark, scratch_path(spark, "stream"), ["user_id"], 4)
    # Later rows arrive first.
    for lower in (600, 0, 300):
        part = events.where(f"event_id >= {lower} and event_id < {lower} + 300")
        part.coalesce(1).write.mode("append").parquet(source)
        run(spark, source, table, checkpoint)
    want = dedupe_latest(events.where("event_id < 900"), ["user_id"], ORDER)
    assert rows(table.read()) == rows(want)
    version = table.version()
    run(spark, source, table, checkpoint)
    assert table.version() == version


def test_a_lost_checkpoint_loses_no_rows(spark, events, tmp_path):
    source = str(tmp_path / "in")
    table = KeyedTable(spark, scratch_path(spark, "stream"), ["user_id"], 4)
    events.where("event_id < 500").coalesce(1).write.parquet(source)
    run(spark, source, table, str(tmp_path / "one"))
    # Rows arrive before the stream starts again without its checkpoint.
    events.where("event_id >= 500").coalesce(1).write.mode("append").parquet(source)
    run(spark, source, table, str(tmp_path / "two"))
    want = rows(dedupe_latest(events, ["user_id"], ORDER))
    assert rows(table.read()) == want
    # Reading everything again changes nothing.
    run(spark, source, table, str(tmp_path / "three"))
    assert rows(table.read()) == want


def test_two_streams_feed_one_table_at_the_same_time(spark, events, tmp_path):
    table = KeyedTable(spark, scratch_path(spark, "stream"), ["user_id"], 4)
    queries = []
    for name, part in (("even", "event_id % 2 = 0"), ("odd", "event_id % 2 = 1")):
        for lower in (500, 0):
            cut = events.where(f"{part} and event_id >= {lower} and event_id < {lower} + 500")
            cut.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
        queries.append(stream_merge(stream, table, ORDER, str(tmp_path / f"checkpoint-{name}")))
    table.compact()  # beside them
    for query in queries:
        query.awaitTermination()
    want = rows(dedupe_latest(events, ["user_id"], ORDER))
    assert rows(table.read()) == want
    table.compact()
    assert rows(table.read()) == want


def test_a_micro_batch_that_comes_again_after_a_crash(spark, events, tmp_path, monkeypatch):
    """The data is written, the commit fails, the stream starts again: the same batch, seen once."""
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    table = KeyedTable(spark, scratch_path(spark, "stream"), ["user_id"], 4)
    events.coalesce(1).write.parquet(source)
    with monkeypatch.context() as broken:
        broken.setattr(KeyedTable, "_commit", lambda self, **commit: 1 / 0)
        try:
            run(spark, source, table, checkpoint)
        except Exception:  # what foreachBatch raised
            pass
    assert table.version() == 0
    run(spark, source, table, checkpoint)
    assert table.version() == 1
    assert rows(table.read()) == rows(dedupe_latest(events, ["user_id"], ORDER))


def test_a_replayed_batch_is_skipped(spark, events):
    table = KeyedTable(spark, scratch_path(spark, "stream"), ["user_id"], 4)
    assert table.merge(events, ORDER, batch="id:0", latest=True).source_rows > 0
    assert table.merge(events.where("event_id < 3"), ORDER, batch="id:0", latest=True).source_rows == 0
    assert table.version() == 1
