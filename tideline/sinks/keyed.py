"""Current-state tables kept by keyed merge: base and delta files of bucketed Spark tables.

A merge appends its rows as a delta, clustered by key into the table's buckets. A reader takes, inside
each bucket, the row that wins for a key: nothing is shuffled, unless buckets are few and what is read of
them is too much for as few tasks. Now and then a base that holds the
winners takes the place of the deltas. Data folders count once a row of the commits names them, so a
merge is seen as a whole or not at all, and writers share nothing that one could take from another.
"""

from __future__ import annotations

import hashlib
import json
import math
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta
from threading import Lock
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.local import nullable, small_frame
from tideline.functions.sizing import BROADCAST_BYTES, materialize_measured, row_bytes
from tideline.operators.merge import MATCHED, conform, dedupe_latest, later, same_key
from tideline.sinks.files import delete, file_system, names, read_folder, read_small, write_once

# Kinds of commits: a base; rows that replace, that only insert, or that replace earlier ones of
# their order.
BASE, UPDATE, INSERT, LATEST = "b", "u", "i", "l"
COMMITS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        # For rows of kind LATEST: the condition on source and target.
        T.StructField("rule", T.StringType()),
        T.StructField("batch", T.StringType()),
        # Of a base: the commits whose place it takes, in ``parts`` if they are bases themselves.
        T.StructField("covers", T.ArrayType(T.StringType())),
        # The partitions that it has rows for; null if the table has none.
        T.StructField("parts", T.ArrayType(T.StringType())),
        # Estimated bytes of its rows.
        T.StructField("bytes", T.LongType()),
    ]
)
OWN_COLUMNS = ("_commit", "_part", "_at", "_kind", "_taken")
# The most estimated bytes that a task takes of a table whose buckets are fewer than the session's shuffle
# partitions; sorting them takes about twice this.
TASK_BYTES = 256 * 1024 * 1024
_registering = Lock()


class Merged(NamedTuple):
    version: int
    source_rows: int


@dataclass(frozen=True)
class Commit:
    name: str
    rule: str | None
    batch: str | None
    covers: frozenset[str]
    parts: frozenset[str] | None
    bytes: int

    @property
    def kind(self) -> str:
        return self.name[21]


class KeyedTable:
    """A table of one row per key.

    ``buckets`` is fixed when the table is created, by default as many as the session has shuffle
    partitions; choose it so that a bucket (of one partition, if there are any) is about one output
    file of 0.5 to 1 GB at the size the table is meant to reach.

    ``part_by`` names a key column whose values partition the table, such as the month of a row that
    keeps its month. ``read`` can be limited to a range of them, and compaction rewrites only those
    that deltas have rows for.

    After a merge that leaves ``deltas`` of them, the table is compacted.

    Any number of writers may merge at a time. What plain and insert-only merges leave then is what
    they leave one after the other; a merge with a condition compares with what it finds when it
    begins, so such merges of one table should follow each other.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        buckets: int | None = None,
        part_by: str | None = None,
        deltas: int = 16,
    ):
        if part_by is not None and part_by not in keys:
            raise ValueError(f"{part_by!r} is no key column: a row could change its partition")
        self.spark = spark
        self.path = path
        self.keys = list(keys)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.part_by = part_by
        self.deltas = deltas
        self.name = "keyed_" + hashlib.sha256(path.encode()).hexdigest()[:24]
        self.schema = None
        self._adopt(read_small(spark, f"{path}/layout"))

    def _adopt(self, layout: str | None) -> None:
        """Take over what the table was created with, by whomever."""
        if layout is None:
            return
        stored = json.loads(layout)
        if (stored["keys"], stored["part_by"]) != (self.keys, self.part_by):
            raise ValueError(f"the table is keyed by {stored['keys']} and partitioned by {stored['part_by']}")
        self.buckets = stored["buckets"]
        self.schema = T.StructType.fromJson(stored["schema"])

    def _create(self, schema: T.StructType) -> None:
        if taken := {name.lower() for name in schema.names} & set(OWN_COLUMNS):
            raise ValueError(f"rename the columns {sorted(taken)}: the table has its own of these names")
        layout = {"keys": self.keys, "part_by": self.part_by, "buckets": self.buckets}
        layout["schema"] = nullable(schema).jsonValue()
        self._adopt(write_once(self.spark, f"{self.path}/layout", json.dumps(layout)))

    # -- reading

    def exists(self) -> bool:
        return self.schema is not None

    def version(self) -> int:
        """The number of the last merge; 0 before the first."""
        return max((int(c.name[:20]) for c in self._commits()), default=0)

    def read(self, from_part: str | None = None, to_part: str | None = None) -> DataFrame:
        """The current rows, or those of a range of partitions, both ends included."""
        if self.schema is None:
            raise ValueError(f"nothing was merged into {self.path} yet")
        commits = self._commits()
        rows = self._rows(commits)
        if from_part is not None:
            rows = rows.where(F.col("_part") >= from_part)
        if to_part is not None:
            rows = rows.where(F.col("_part") <= to_part)
        wanted = {
            part
            for c in commits
            for part in c.parts or ()
            if (from_part is None or part >= from_part) and (to_part is None or part <= to_part)
        }
        return self._winners(rows, commits, self._tasks(commits, wanted))

    def _commits(self) -> list[Commit]:
        """What counts, by name: all deltas that no base covers, and all bases with rows left.

        Of commits of one batch the first counts, and of bases that cover the same delta, too: two
        drivers may have repeated a batch or compacted at the same time.
        """
        found = read_folder(self.spark, f"{self.path}/commits", COMMITS).collect()
        every = sorted(
            (
                Commit(
                    c.name,
                    c.rule,
                    c.batch,
                    frozenset(c.covers or ()),
                    None if c.parts is None else frozenset(c.parts),
                    c.bytes or 0,
                )
                for c in found
            ),
            key=lambda c: c.name,
        )
        deltas, batches = [], set()
        for c in every:
            if c.kind != BASE and (c.batch is None or c.batch not in batches):
                batches.add(c.batch)
                deltas.append(c)
        bases, covered = [], set()
        for c in every:
            own = {name for name in c.covers if name[21] != BASE}
            if c.kind == BASE and not own & covered:
                covered |= own
                bases.append(c)
        bases = [b for b in bases if b.parts is None or b.parts - self._replaced(b, bases)]
        if self.part_by is None:
            replaced = {name for b in bases for name in b.covers}
            bases = [b for b in bases if b.name not in replaced]
        return [c for c in deltas if c.name not in covered] + bases

    @staticmethod
    def _replaced(base: Commit, bases: Sequence[Commit]) -> set[str]:
        """The partitions of a base that later ones have taken over."""
        return {part for b in bases if base.name in b.covers for part in b.parts or ()}

    def _rows(self, commits: Sequence[Commit]) -> DataFrame:
        """The rows of the commits, before one row per key is chosen."""
        alive = F.col("_commit").isin([c.name for c in commits])
        for c in commits:
            gone = self._replaced(c, commits) if c.kind == BASE else ()
            if gone:
                alive = alive & ~((F.col("_commit") == c.name) & F.col("_part").isin(sorted(gone)))
        return self._table().where(alive)

    def _table(self) -> DataFrame:
        """The data as a bucketed table of the session's catalog, which is told of it when it is not there."""
        own = ["_commit"] if self.part_by is None else ["_commit", "_part"]
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields]
        keys = ", ".join(f"`{k}`" for k in self.keys)
        files, at = file_system(self.spark, f"{self.path}/data")
        files.mkdirs(at)
        with _registering:
            # Folders come from other sessions too: the file system knows them, no catalog does.
            tracked = "spark.sql.hive.manageFilesourcePartitions"
            before = self.spark.conf.get(tracked)
            self.spark.conf.set(tracked, "false")
            try:
                self.spark.sql(
                    f"CREATE TABLE IF NOT EXISTS {self.name} ({', '.join(columns + [f'{c} string' for c in own])})"
                    f" USING parquet PARTITIONED BY ({', '.join(own)}) CLUSTERED BY ({keys}) SORTED BY ({keys})"
                    f" INTO {self.buckets} BUCKETS LOCATION '{self.path}/data'"
                )
            finally:
                self.spark.conf.set(tracked, before)
            self.spark.catalog.refreshTable(self.name)
            return self.spark.table(self.name)

    def _few_buckets(self) -> bool:
        """Whether a shuffle gives more tasks than the buckets do."""
        return self.buckets < int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _tasks(self, commits: Sequence[Commit], wanted: frozenset[str] | set[str] = frozenset()) -> int:
        """How many tasks the rows of the commits, in the ``wanted`` partitions, are dealt to by key: one
        for each bucket, or else more than there are buckets."""
        if not self._few_buckets():
            return self.buckets
        size = 0.0
        for c in commits:
            there = (c.parts or frozenset()) - (self._replaced(c, commits) if c.kind == BASE else set())
            size += c.bytes * (len(there & wanted) / len(c.parts) if c.parts else 1)
        if size <= self.buckets * TASK_BYTES:
            return self.buckets
        return max(math.ceil(size / TASK_BYTES), int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def _winners(self, rows: DataFrame, commits: Sequence[Commit], tasks: int) -> DataFrame:
        """One row per key: what merging the commits one after the other leaves.

        An update replaces what was there; an insert counts if nothing was there. So the last update
        wins, else the base, else the first insert. With more ``tasks`` than buckets the rows are shuffled.
        """
        kinds = {c.kind for c in commits}
        if kinds <= {BASE}:
            return rows.select(self.schema.names)
        if tasks > self.buckets:
            rows = rows.repartition(tasks, *self.keys)
        if LATEST in kinds:
            return self._folded(rows, commits)
        commit, kind = F.col("_commit"), F.substring("_commit", 22, 1)
        order = [
            F.when(kind == UPDATE, commit).desc_nulls_last(),
            (kind == BASE).desc(),
            commit.asc(),
        ]
        return dedupe_latest(rows, self.keys, order).select(self.schema.names)

    def _folded(self, rows: DataFrame, commits: Sequence[Commit]) -> DataFrame:
        """The same by a fold over the rows of a key, at most one for each commit."""
        kind = F.substring("_commit", 22, 1)
        at = F.concat(F.when(kind == BASE, "0").otherwise("1"), "_commit")
        row = F.struct(*self.schema.names, at.alias("_at"), kind.alias("_kind"))
        by_rule: dict[str, list[str]] = {}
        for c in commits:
            if c.kind == LATEST:
                by_rule.setdefault(c.rule, []).append(f"'1{c.name}'")
        # A rule speaks of source and target: names of the lambda's arguments here.
        rules = " ".join(f"WHEN source._at IN ({', '.join(at)}) THEN ({rule})" for rule, at in by_rule.items())
        won = rows.groupBy(*self.keys).agg(_in_order(F.collect_list(row), "_at").alias("_rows")).selectExpr(
            "aggregate(slice(_rows, 2, size(_rows)), _rows[0], (target, source) ->"
            f" CASE source._kind WHEN '{UPDATE}' THEN source WHEN '{INSERT}' THEN target"
            f" ELSE IF(coalesce(CASE {rules} END, false), source, target) END) AS _row"
        )
        return won.select("_row.*").select(self.schema.names)

    # -- merging

    def merge(
        self,
        source: DataFrame,
        order: Sequence[str | Column],
        when: str | None = None,
        matched: str = "update",
        batch: str | None = None,
        limit: int = BROADCAST_BYTES,
        latest: bool = False,
        steps: str | None = None,
    ) -> Merged:
        """Merge the latest source row of each key, see ``operators.merge``.

        Without a condition this only appends. With ``when``, the rows of the source's keys are
        read and the rows that change are appended: a source of up to ``limit`` bytes is broadcast
        for that, and the table is not shuffled in any case.

        ``latest`` updates a row only by one that is later in ``order``, whatever order merges come in;
        the comparison is made by readers, so nothing is read here.

        ``steps`` names a further column of the source: the latest rows of each of its values are merged
        one after the other, in its order, by one plan.

        A ``batch`` name that was merged before is skipped, so a replay of the same batch does nothing.
        Their names are known until ``vacuum`` forgets them.
        """
        if matched not in MATCHED:
            raise ValueError(f"matched must be one of {MATCHED}, not {matched!r}")
        if batch is not None and self._has(batch):
            return Merged(self.version(), 0)
        if self.schema is not None:
            source = self._conformed(source, steps)
        kind, rule = (UPDATE, None) if matched == "update" else (INSERT, None)
        rows = None
        if latest:
            kind, rule = LATEST, later(order)
        if when is not None and matched == "update":
            out, rows = self._changed(source, order, when, steps, limit)
        elif steps and matched == "ignore":
            out = dedupe_latest(source, self.keys, [F.col(steps).asc(), *order]).drop(steps)
        else:
            out = dedupe_latest(source, self.keys, [steps, *order] if steps else order)
            out = out.drop(steps) if steps else out
        if self.schema is None:
            self._create(out.schema)
        version, appended = self._append(self._conformed(out), kind, rule, batch)
        if not latest and sum(c.kind != BASE for c in self._commits()) >= self.deltas:
            self.compact()
        return Merged(version, appended if rows is None else rows)

    def _conformed(self, source: DataFrame, steps: str | None = None) -> DataFrame:
        """The source with the table's columns, and the steps' beside them."""
        rest = [steps] if steps else []
        conform(source.drop(*rest), small_frame(self.spark, [], self.schema))
        return source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields], *rest)

    def _changed(
        self, source: DataFrame, order: Sequence[str | Column], when: str, steps: str | None, limit: int
    ) -> tuple[DataFrame, int]:
        """The source rows that a conditional merge takes into the table, and the number of all that it
        looked at."""
        by = [*self.keys, *([steps] if steps else [])]
        null_key = F.array_contains(F.array(*[F.isnull(k) for k in self.keys]), True)
        measures = {"rows": F.count(F.lit(1)), "null_keys": F.max(null_key)}
        if self.part_by is not None:
            measures["parts"] = F.collect_set(F.col(self.part_by).cast("string"))
        # Written once: its size decides the strategy and two scans follow.
        rows, seen = materialize_measured(dedupe_latest(source, by, order), "merge-source", **measures)
        columns = [c for c in rows.columns if c != steps]
        if not seen["rows"]:
            return rows.select(columns), 0
        row = F.struct(*columns, F.lit(True).alias("_taken"))
        step = F.struct((F.col(steps) if steps else F.lit(0)).alias("_step"), row.alias("_row"))
        lists = rows.groupBy(*self.keys).agg(_in_order(F.collect_list(step), "_step").alias("_steps"))
        lists = lists.select(*self.keys, F.transform("_steps", lambda s: s["_row"]).alias("_steps"))
        small = seen["bytes"] <= limit
        if self.schema is None:
            met = lists.withColumn("_old", F.lit(None).cast(rows.select(row.alias("r")).schema["r"].dataType))
        else:
            wanted = rows.select(*self.keys).distinct()
            commits = self._commits()
            tasks = self.buckets if small else self._tasks(commits, frozenset(seen.get("parts") or ()))
            wanted = F.broadcast(wanted) if small else wanted.repartition(tasks, *self.keys)
            there = self._rows(commits)
            if self.part_by:
                there = there.where(F.col("_part").isin(seen["parts"]))
            there = there.repartition(tasks, *self.keys) if tasks > self.buckets else there
            same = same_key(self.keys, bool(seen["null_keys"]))
            there = there.alias("target").join(wanted.alias("source"), same, "left_semi")
            old = F.struct(*columns, F.lit(False).alias("_taken")).alias("_old")
            old = self._winners(there, commits, self.buckets).select(old, *self.keys)
            lists = lists if small else lists.repartition(tasks, *self.keys)
            met = lists.alias("source").join(old.alias("target"), same, "left").select("source._steps", "target._old")
        # The condition speaks of source and target: names of the lambda's arguments here.
        rule = f"target IS NULL OR coalesce(({when}), false)"
        folded = met.selectExpr(f"aggregate(_steps, _old, (target, source) -> IF({rule}, source, target)) AS _new")
        return folded.where("_new._taken").select("_new.*").drop("_taken"), seen["rows"]

    def _append(self, out: DataFrame, kind: str, rule: str | None = None, batch: str | None = None) -> tuple[int, int]:
        """Write rows and commit them; the version and the number of rows."""
        version = self.version()
        name = f"{version + 1:020d}-{kind}-{uuid.uuid4().hex[:12]}"
        seen = self._write(out, name)
        if not seen["rows"]:
            delete(self.spark, self._folder(name))
            return version, 0
        self._commit(name=name, rule=rule, batch=batch, parts=seen["parts"], bytes=seen["bytes"])
        return version + 1, seen["rows"]

    def _write(self, out: DataFrame, name: str, deal: bool = True) -> dict:
        """Write a commit's rows, one file for each bucket and partition, or several for a large one.

        ``deal`` brings the rows of a bucket together. Buckets that are few would be as few tasks: then
        REBALANCE does it, which cuts large ones.
        """
        seen = Observation()
        part = F.lit(None) if self.part_by is None else F.col(self.part_by).cast("string")
        measures = [F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(out.schema)).alias("bytes")]
        if self.part_by is not None:
            measures += [F.collect_set("_part").alias("parts"), F.count_if(F.col("_part").isNull()).alias("no_part")]
        if deal and not self._few_buckets():
            out = out.repartition(self.buckets, *self.keys)
        out = out.withColumn("_part", part)
        if deal and self._few_buckets():
            # The number that Spark's writer gives a row's bucket.
            bucket = F.pmod(F.hash(*self.keys), F.lit(self.buckets))
            out = out.withColumn("_at", bucket).hint("rebalance", "_part", "_at").drop("_at")
        out = out.observe(seen, *measures)
        writer = (out if self.part_by else out.drop("_part")).write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        if self.part_by is not None:
            writer = writer.partitionBy("_part")
        # Only a table of the catalog can be written in buckets: it gets a name for that long.
        table = f"commit_{uuid.uuid4().hex}"
        writer.format("parquet").option("path", self._folder(name)).saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")
        found = {"parts": None, "no_part": 0, **seen.get}
        if found["no_part"]:
            delete(self.spark, self._folder(name))
            raise ValueError(f"{self.part_by!r} is empty in some rows and partitions the table")
        return found

    def _folder(self, name: str) -> str:
        return f"{self.path}/data/_commit={name}"

    def _commit(self, **commit: object) -> None:
        """One file, so that readers see all of a merge or none of it."""
        rows = small_frame(self.spark, [commit], COMMITS).coalesce(1)
        rows.write.parquet(f"{self.path}/commits/{commit['name']}")

    def _has(self, batch: str) -> bool:
        found = read_folder(self.spark, f"{self.path}/commits", COMMITS)
        return not found.where(F.col("batch") == batch).isEmpty()

    # -- upkeep

    def compact(self) -> None:
        """Put a base in the place of the deltas, in the partitions that they have rows for.

        Readers and writers may go on meanwhile: a delta that comes in between is not covered.
        """
        commits = self._commits()
        deltas = [c for c in commits if c.kind != BASE]
        if not deltas:
            return
        parts = None if self.part_by is None else frozenset().union(*(c.parts for c in deltas))
        rows = self._rows(commits)
        if parts is not None:
            rows = rows.where(F.col("_part").isin(sorted(parts)))
        covers = [c.name for c in commits if c.kind != BASE or parts is None or c.parts & parts]
        version = max(int(c.name[:20]) for c in commits)
        name = f"{version:020d}-{BASE}-{uuid.uuid4().hex[:12]}"
        tasks = self._tasks(commits, parts or frozenset())
        seen = self._write(self._winners(rows, commits, tasks), name, deal=tasks > self.buckets)
        self._commit(name=name, covers=covers, parts=None if parts is None else sorted(parts), bytes=seen["bytes"])

    def vacuum(self, older: timedelta = timedelta(days=7)) -> int:
        """Delete folders and commits that no longer count; how many.

        Only those older than ``older`` go, which has to be longer than any merge, compaction or read takes.
        """
        until = (time.time() - older.total_seconds()) * 1000
        alive, gone = {c.name for c in self._commits()}, 0
        for folder, prefix in (("commits", ""), ("data", "_commit=")):
            for entry in names(self.spark, f"{self.path}/{folder}"):
                at = f"{self.path}/{folder}/{entry}"
                files, place = file_system(self.spark, at)
                if entry.removeprefix(prefix) not in alive and files.getFileStatus(place).getModificationTime() < until:
                    delete(self.spark, at)
                    gone += 1
        return gone


def _in_order(rows: Column, by: str) -> Column:
    """An array of structs in the order of one field; others may be of kinds that have no order."""
    return F.array_sort(rows, lambda a, b: F.when(a[by] < b[by], -1).when(a[by] > b[by], 1).otherwise(0))
