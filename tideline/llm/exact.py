"""Exact deduplication against a persistent digest index."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import fresh, save, text_of
from tideline.llm.urls import BlockedBloomFilter
from tideline.sinks.files import delete, names, read_small, write_once


def text_digest(column: str) -> Column:
    """The 32 bytes of the text's SHA-256; null is the empty text."""
    return F.unhex(F.sha2(text_of(column), 256))


class DigestIndex:
    """The digests of all texts seen so far, each with the id of the row that stays.

    A table of one row per digest, bucketed and sorted by digest, in a folder that outlives the
    session: opening the folder again goes on with what it holds. New data is deduplicated within
    itself, compared by sort-merge anti-join (the index side is not shuffled), and appended.

    Rules: null text is the empty text. Of equal texts in one batch the row with the largest id
    stays; a text that an earlier batch brought belongs to the row that it kept then, so adding a
    batch again changes nothing. Rows that repeat an id with the same text are one document and
    share its verdict. A row without an id stays only where no row of its group has one.
    An empty batch adds nothing.

    ``buckets`` should give bucket files of some hundred MB (a row takes about 50 bytes). The number that
    a folder was made with is kept in it: by default it is taken over, and another one is refused.

    One writer at a time: of two that add at once, both may append a text that is new to both. Such a
    digest counts once all the same; it belongs to the larger of the two ids. Each batch adds a file to a
    bucket; ``compact`` makes one sorted file of them again.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, id_type: str = "bigint"):
        self.spark, self.path, self.id_type = spark, path, id_type
        wanted = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = int(write_once(spark, f"{path}/buckets", str(wanted)))
        if buckets is not None and buckets != self.buckets:
            raise ValueError(f"{path} has {self.buckets} buckets and cannot be opened with {buckets}")
        self._open(max(map(int, names(spark, f"{path}/generations")), default=0))

    def _open(self, generation: int) -> None:
        """Go on with the table that the given compaction wrote, or the first one."""
        folder = read_small(self.spark, f"{self.path}/generations/{generation}") if generation else "data"
        self.generation = generation
        self.name = self._register(folder)

    def _register(self, folder: str) -> str:
        """Tell the session's catalog of the table in a folder; its name."""
        place = f"{self.path}/{folder}"
        name = "digest_index_" + hashlib.sha256(place.encode()).hexdigest()[:24]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id {self.id_type}) USING parquet"
            f" CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )
        return name

    def table(self) -> DataFrame:
        """(digest, keep_id), a row for each digest."""
        return self.spark.table(self.name).groupBy("digest").agg(F.max("keep_id").alias("keep_id"))

    def compact(self) -> None:
        """Write one sorted file for each bucket, from then on instead of all before. Nothing is shuffled."""
        folder = f"data-{uuid.uuid4().hex}"
        self.table().write.insertInto(self._register(folder))
        taken = write_once(self.spark, f"{self.path}/generations/{self.generation + 1}", folder)
        if taken != folder:
            delete(self.spark, f"{self.path}/{folder}")  # another writer was first
        self._open(self.generation + 1)

    def add(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """Append what is new; one row per row of ``docs``: id, digest, keep_id, group_size, kept.

        ``group_size`` counts the rows of the batch with this text.
        """
        rows = save(
            docs.select(F.col(f"`{id_column}`").alias("id"), text_digest(text_column).alias("digest")),
            "digests",
        )
        groups = save(
            rows.groupBy("digest").agg(F.max("id").alias("newest"), F.count(F.lit(1)).alias("group_size")),
            "digest-groups",
        )
        new = groups.join(self.table().hint("merge"), "digest", "left_anti")
        (
            new.select("digest", F.col("newest").alias("keep_id"))
            .repartition(self.buckets, "digest")
            .sortWithinPartitions("digest")
            .write.insertInto(self.name)
        )
        verdicts = save(groups.join(self.table().hint("merge"), "digest").drop("newest"), "digest-verdicts")
        # Rows and verdicts are plain scans: a hot digest is split by AQE's skew join.
        return rows.join(verdicts, "digest", "left").select(
            "id", "digest", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept")
        )

    def keep_new(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """The rows of ``docs`` that stay, with all their columns.

        Texts are moved only where a Bloom filter of the digests of lost rows says that theirs may
        be among them, as long as that filter is small enough to broadcast.
        """
        decided = self.add(docs, id_column, text_column)
        mark, lost_id = fresh(docs, "text_digest"), fresh(docs, "lost_id")
        lost = decided.where(~F.col("kept")).select(F.col("id").alias(lost_id), F.col("digest").alias(mark))
        lost = save(lost, "digest-lost")
        marked = docs.withColumn(mark, text_digest(text_column))
        bloom = BlockedBloomFilter(lost.select(mark).distinct(), mark)
        maybe = bloom.possible(marked, mark, keep_word=True) if bloom.small() else marked
        same = F.col(f"`{id_column}`").eqNullSafe(lost[lost_id]) & (maybe[mark] == lost[mark])
        if bloom.small():
            # Always true; without it the optimizer would join before it looks into the filter.
            same = same & maybe[bloom.words[0]].isNotNull()
        # Shuffled at every size: what may be lost grows with the data.
        kept = maybe.hint("merge").join(lost, same, "left_anti").select(marked.columns)
        if bloom.small():
            kept = kept.unionByName(bloom.impossible(marked, mark))
        return kept.drop(mark)
