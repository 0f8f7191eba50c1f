"""Keyed merge of a deduplicated source into current-state rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.functions.sizing import BROADCAST_BYTES, row_bytes

MATCHED = ("update", "ignore")


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the one that ``order`` puts last.

    Plain names sort latest first with nulls last; give a Column for anything else.
    The order must be total, or the survivor is not determined. Spark turns the
    rank filter into a group limit on both sides of the shuffle, so at most one row
    per key and map task crosses it however many rows a key has.
    """
    latest_first = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]
    window = W.partitionBy(*keys).orderBy(*latest_first)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def conform(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source`` with the columns of ``target``, in its order and types."""
    missing = set(target.columns) ^ set(source.columns)
    if missing:
        raise ValueError(f"source and target columns differ: {sorted(missing)}")
    return source.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    )


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    when: str | None = None,
    matched: str = "update",
    small_source: bool = False,
    null_keys: bool = True,
) -> DataFrame:
    """``target`` after merging ``source`` into it; both hold one row per key.

    A null in a key is a value like others, here as in ``dedupe_latest``. A caller that has
    counted no null in the source's keys may say so with ``null_keys=False``: then keys are
    compared with ``=``, which lets a join use a partitioning by the keys that is there already.

    Unmatched target rows stay, unmatched source rows are inserted. A matched row
    becomes the source row, or only where ``when`` is true: SQL over ``source.x``
    and ``target.x``, null counting as false. ``matched="ignore"`` only inserts.

    ``small_source`` says that the source is expected to be small. Its rows are measured, and if
    they fit in ``BROADCAST_BYTES`` they are broadcast. Then the target is not shuffled: it is
    scanned once in full and once for its keys.
    Otherwise one full outer join shuffles both sides by key; as keys are unique on
    each side, no key can be hot.
    """
    if matched not in MATCHED:
        raise ValueError(f"matched must be one of {MATCHED}, not {matched!r}")
    source = conform(source, target)
    if small_source:
        size = source.agg(F.sum(row_bytes(source.schema))).first()[0] or 0
        small_source = size <= BROADCAST_BYTES
    if matched == "ignore":
        return target.unionByName(unmatched(target, source, keys, small_source, null_keys))
    if small_source:
        new = unmatched(target, source, keys, small_source, null_keys)
        return matched_rows(target, source, keys, when, null_keys).unionByName(new)
    return _take(target, _marked(source), keys, when, "full", null_keys)


def matched_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    when: str | None = None,
    null_keys: bool = True,
) -> DataFrame:
    """The target's rows, updated from a source small enough to broadcast."""
    return _take(target, F.broadcast(_marked(source)), keys, when, "left", null_keys)


def unmatched(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    small_source: bool = False,
    null_keys: bool = True,
) -> DataFrame:
    """Source rows whose key the target lacks."""
    there = target.select(*keys)
    if small_source:
        # The target's keys are narrowed to those of the source first, so what is
        # broadcast for the second join is no larger than the source.
        wanted = F.broadcast(source.select(*keys))
        there = there.alias("target").join(
            wanted.alias("source"), same_key(keys, null_keys), "left_semi"
        )
        there = F.broadcast(there)
    return source.alias("source").join(
        there.alias("target"), same_key(keys, null_keys), "left_anti"
    )


def same_key(keys: Sequence[str], null_keys: bool) -> list[Column]:
    pairs = [(F.col(f"target.`{k}`"), F.col(f"source.`{k}`")) for k in keys]
    return [t.eqNullSafe(s) if null_keys else t == s for t, s in pairs]


def later(order: Sequence[str]) -> str:
    """The condition that ``source`` sorts after ``target``; nulls sort first, as in the deduplication."""
    sides = [", ".join(f"{side}.`{c}`" for c in order) for side in ("source", "target")]
    return f"struct({sides[0]}) > struct({sides[1]})"


def _marked(source: DataFrame) -> DataFrame:
    return source.withColumn("_in_source", F.lit(True))


def _take(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    when: str | None,
    how: str,
    null_keys: bool,
) -> DataFrame:
    # Presence comes from marker columns: a null value in a source row must still
    # win over the target's value.
    left = target.withColumn("_in_target", F.lit(True)).alias("target")
    right = source.alias("source")
    on = same_key(keys, null_keys)
    allowed = F.coalesce(F.expr(when), F.lit(False)) if when else F.lit(True)
    from_source = F.col("source._in_source").isNotNull() & (
        F.col("target._in_target").isNull() | allowed
    )
    return left.join(right, on, how).select(
        *[
            F.when(from_source, F.col(f"source.`{c}`"))
            .otherwise(F.col(f"target.`{c}`"))
            .alias(c)
            for c in target.columns
        ]
    )


def merge_into_table(
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    when: str | None = None,
    matched: str = "update",
) -> None:
    """The same merge as a row-level ``MERGE`` into a catalog table that supports it.

    For lakehouse tables, whose format rewrites only the files that change.
    """
    if matched not in MATCHED:
        raise ValueError(f"matched must be one of {MATCHED}, not {matched!r}")
    on = " AND ".join(f"target.`{key}` <=> source.`{key}`" for key in keys)
    update = f"WHEN MATCHED{f' AND ({when})' if when else ''} THEN UPDATE SET *"
    source.sparkSession.sql(
        f"MERGE INTO IDENTIFIER(:table) AS target USING {{source}} AS source ON {on}"
        f" {update if matched == 'update' else ''} WHEN NOT MATCHED THEN INSERT *",
        args={"table": table},
        source=source,
    )
