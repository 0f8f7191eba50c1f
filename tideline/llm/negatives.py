"""Hard negatives by threshold joins over vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import save, slices

# Components are whole numbers below this in size, so that scores fit 64 bits.
LARGEST = 1 << 24
_LOWEST, _HIGHEST = -(1 << 62), 1 << 62


@dataclass(frozen=True)
class Mining:
    """Of each anchor the best ``positives`` rows of its label; for each of these the best ``negatives`` rows of
    other labels with a score of ``low`` to ``high`` percent of the positive's.

    Anchors are taken in blocks of about ``block``. Rows are indexed ``rows`` at a time, in lists of ``chunk``
    dimensions. Thresholds fall through ``steps``: shares of the highest score there could be for
    positives, of a window's upper end for negatives; after the last there is none.
    """

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    block: int = 4096
    rows: int = 4096
    chunk: int = 16
    steps: tuple[float, ...] = (0.75, 0.5, 0.35, 0.25)
    window_steps: tuple[float, ...] = (0.9, 0.7)


@dataclass
class _Anchor:
    row: int
    id: int
    label: object
    vector: np.ndarray
    # Of the windows that are open: number, lowest and highest score, the threshold in this round, how many rows fill it,
    # and the positive's id and score.
    windows: list[tuple]


@dataclass
class _Round:
    """What tasks get by broadcast: a block of anchors with the thresholds of this round."""

    anchors: list[_Anchor]
    same: bool  # look for rows of the anchor's label, or of all others
    order: np.ndarray  # dimensions, those that tell most first

    def least(self) -> float:
        """The smallest norm that a row needs to reach any threshold."""
        least = np.inf
        for a in self.anchors:
            norm, t = np.linalg.norm(a.vector.astype(float)), min(max(w[1], w[3]) for w in a.windows)
            least = min(least, (t - 0.5) / norm if norm else -np.inf)
        return least


class _Lists:
    """An inverted index of some rows: for each chunk of dimensions the rows that are in its list.

    A row is in the lists up to the place from which its rest is too short, whatever the anchor, to reach a threshold alone. Rows are
    sorted by that place, so a list is a prefix of all rows.
    """

    def __init__(self, ids, rows, labels: list, vectors: np.ndarray, order: np.ndarray, chunk: int, least: float):
        vectors = _wide(vectors, len(order))[:, order]
        ends = [*range(0, len(order), chunk), len(order)]
        squares = [(vectors[:, s:e].astype(float) ** 2).sum(axis=1) for s, e in zip(ends, ends[1:])]
        # The norm of what a row still has at the start of each chunk, and at the end.
        rest = np.sqrt(np.cumsum([np.zeros(len(rows)), *squares[::-1]], axis=0)[::-1])
        length = (rest[:-1] >= least).sum(axis=0)
        by_length = np.argsort(-length, kind="stable")
        self.listed = [int((length > c).sum()) for c in range(len(ends) - 1)]
        self.rest, vectors = rest[:, by_length], vectors[by_length]
        # Products below 2**53 in all are exact as floats, and quicker.
        largest = float(np.abs(vectors).max(initial=0))
        self.kind = np.float64 if largest * LARGEST * len(order) < 2**53 else np.int64
        self.chunks = [np.ascontiguousarray(vectors[:, s:e], self.kind) for s, e in zip(ends, ends[1:])]
        self.ends, self.order = ends, order
        self.ids, self.rows = ids[by_length], rows[by_length]
        self.groups: dict = {}
        for i, at in enumerate(by_length):
            self.groups.setdefault(labels[at], []).append(i)
        self.groups = {label: np.array(at) for label, at in self.groups.items()}
        self.others: dict = {}

    def _asked(self, label, same: bool) -> np.ndarray:
        if same:
            return self.groups.get(label, np.empty(0, np.int64))
        if label not in self.others:
            self.others[label] = np.setdiff1d(np.arange(len(self.rows)), self.groups.get(label, ()))
        return self.others[label]

    def reaching(self, anchor: _Anchor, same: bool, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of the rows that score the threshold or more.

        Partial scores grow list by list; a row goes as soon as the norms of what is left of it and of the anchor
        can't lift it to the threshold. What the lists omit is added for those that stay.
        """
        vector = _wide(anchor.vector[None], len(self.order))[0, self.order].astype(self.kind)
        at = self._asked(anchor.label, same)
        at = at[self.rows[at] != anchor.row]
        score = np.zeros(len(at), self.kind)
        spans = list(zip(self.ends, self.ends[1:]))
        left = [float(np.linalg.norm(vector[s:].astype(float))) for s, _ in spans] + [0.0]
        for c, (s, e) in enumerate(spans):
            n = np.searchsorted(at, self.listed[c])
            score[:n] += self.chunks[c][at[:n]] @ vector[s:e]
            # Scores are whole numbers: half of one is room for what floats lose.
            stays = score + left[c + 1] * self.rest[c + 1, at] >= threshold - 0.5
            stays[n:] = True  # judged at the end of their lists
            at, score = at[stays], score[stays]
        for c, (s, e) in enumerate(spans):
            n = np.searchsorted(at, self.listed[c])
            score[n:] += self.chunks[c][at[n:]] @ vector[s:e]
        stays = score >= threshold
        return at[stays], score[stays].astype(np.int64)

    def best(self, at: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """Places of the k highest scores, equal ones by id."""
        places = np.arange(len(at))
        if len(at) > k:
            places = np.flatnonzero(score >= np.partition(score, -k)[-k])
        return places[np.lexsort((self.rows[at[places]], self.ids[at[places]], -score[places]))][:k]


def _wide(vectors: np.ndarray, dimensions: int) -> np.ndarray:
    """Shorter vectors go on with zeros."""
    return np.pad(vectors, ((0, 0), (0, dimensions - vectors.shape[1])))


def _matrix(lists: pa.Array) -> np.ndarray:
    """The rows of a list column, shorter ones filled up with zeros."""
    values, size = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
    made = np.zeros((len(size), size.max(initial=0)), np.int64)
    made[np.arange(made.shape[1])[None, :] < size[:, None]] = values
    return made


_FOUND = [
    ("anchor", pa.int64(), "bigint"),
    ("anchor_id", pa.int64(), "bigint"),
    ("number", pa.int32(), "int"),
    ("positive_id", pa.int64(), "bigint"),
    ("positive_score", pa.int64(), "bigint"),
    ("needed", pa.int32(), "int"),
    ("last", pa.bool_(), "boolean"),
    ("id", pa.int64(), "bigint"),
    ("row", pa.int64(), "bigint"),
    ("score", pa.int64(), "bigint"),
]


def _scan(rows: DataFrame, asked: _Round, mining: Mining) -> DataFrame:
    """For every open window the best rows of each slice of the table that reach the threshold."""
    shared = rows.sparkSession.sparkContext.broadcast(asked)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        least = asked.least()
        for batch in slices(batches, mining.rows):
            ids, numbers = (batch.column(c).to_numpy() for c in ("id", "row"))
            labels, vectors = batch.column("label").to_pylist(), _matrix(batch.column("vector"))
            lists, found = _Lists(ids, numbers, labels, vectors, asked.order, mining.chunk, least), []
            for a in asked.anchors:
                at, score = lists.reaching(a, asked.same, min(max(w[1], w[3]) for w in a.windows))
                for number, low, high, threshold, needed, positive, positive_score in a.windows:
                    inside = np.flatnonzero((score >= max(low, threshold)) & (score <= high))
                    for i in inside[lists.best(at[inside], score[inside], needed)]:
                        tag = (a.row, a.id, number, positive, positive_score, needed, threshold <= low)
                        found.append((*tag, lists.ids[at[i]], lists.rows[at[i]], score[i]))
            columns = list(zip(*found)) or [()] * len(_FOUND)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, (_, t, _) in zip(columns, _FOUND)], names=[name for name, _, _ in _FOUND]
            )

    return rows.mapInArrow(work, ", ".join(f"{name} {sql}" for name, _, sql in _FOUND))


def _best(found: DataFrame) -> DataFrame:
    """The best rows of each window with their ranks, and how many there are."""
    window = Window.partitionBy("anchor", "number")
    ranked = found.withColumn("rank", F.row_number().over(window.orderBy(F.desc("score"), "id", "row")))
    return ranked.where(F.col("rank") <= F.col("needed")).withColumn("n", F.count(F.lit(1)).over(window))


def _filled(rows: DataFrame, asked: _Round, thresholds, mining: Mining, label: str) -> list[DataFrame]:
    """The best rows of all windows of a block: round by round with lower thresholds, until each is full or its lower end
    is reached. ``thresholds`` gives those of a round for an anchor's window."""
    done, step = [], 0
    while asked.anchors:
        for a in asked.anchors:
            a.windows = [(*w[:3], thresholds(a, w, step), *w[4:]) for w in a.windows]
        best = save(_best(_scan(rows, asked, mining)), f"negatives-{label}-{step}")
        full = best.where("last or n = needed")
        done.append(full)
        # A row for each window that is still open, at most: bounded by the block.
        filled = {(r.anchor, r.number) for r in full.select("anchor", "number").distinct().collect()}
        for a in asked.anchors:
            a.windows = [w for w in a.windows if w[3] > w[1] and (a.row, w[0]) not in filled]
        asked.anchors = [a for a in asked.anchors if a.windows]
        step += 1
    return done


def _energies(rows: DataFrame) -> DataFrame:
    """(dimension, energy): the sum of squares in each dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = (_matrix(batch.column(0)).astype(float) ** 2).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], names=["dimension", "energy"])

    sums = rows.select("vector").mapInArrow(work, "dimension bigint, energy double")
    return sums.groupBy("dimension").agg(F.sum("energy").alias("energy"))


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """Components times ``scale``, rounded down; null where any is null or not finite, or too large for
    scores of 64 bits."""
    scaled = F.transform(vector, lambda x: F.floor(scale * x.cast("double")))
    off = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(scale * x.cast("double")) >= LARGEST))
    return F.when(~off, scaled)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    mining: Mining = Mining(),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the inner product of two vectors of whole numbers (``whole_numbers``). Of an anchor's row,
    positives are the ``positives`` other rows of its label with the highest scores (all, if fewer); of each positive,
    negatives are the ``negatives`` rows of other labels with the highest scores within ``low`` to ``high``
    percent of the positive's. Equal scores go by smaller id.

    Both are threshold joins of anchors with all rows. A task indexes a slice of rows by chunks of dimensions, without
    those from which the norm of what is left cannot reach a threshold alone; it adds up partial scores
    chunk by chunk and drops a row once the norms of what is left cannot lift it to the threshold. Windows that
    did not fill are asked again with a lower threshold. So all that is
    left out provably does not belong: the answer is exact. Vectors are not shuffled; anchors
    come in blocks of about ``block``, which bounds what is broadcast and what the driver holds.

    Rows without an id or a label, without a vector, or with a component that is null, not
    finite or 65,536 or more in size (2**24 / 256) take no part. Ids are integers. Shorter vectors go on with zeros. Rows that
    repeat an id are rows of their own, also as anchors: then their answers repeat the id. A
    positive whose window is empty, as with a negative score, has no negatives. Without anchors or
    rows the answer is empty. Other columns are not read.
    """
    spark = vectors.sparkSession
    of = F.col(f"`{label}`") if isinstance(label, str) else label
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        of.alias("label"),
        whole_numbers(F.col(f"`{vector}`")).alias("vector"),
        anchors.alias("anchor"),
    ).where("id is not null and label is not null and vector is not null")
    rows = save(rows.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    # A dimension's row each.
    energies = {r.dimension: r.energy for r in _energies(rows).collect()}
    order = np.array(sorted(energies, key=lambda d: (-energies[d], d)), np.int64)
    squares = F.aggregate("vector", F.lit(0.0), lambda sum_, x: sum_ + x * x)
    count, longest = rows.agg(F.count(F.lit(1)), F.sqrt(F.max(squares))).first()
    labels = rows.groupBy("label").agg(F.count(F.lit(1)).alias("of_label"))
    chosen = save(rows.where("anchor").join(save(labels, "negatives-labels"), "label"), "negatives-anchors")
    blocks = -(-chosen.count() // mining.block)
    slices_ = -(-count // mining.rows)
    table = rows.select("id", "row", "label", "vector")
    if table.rdd.getNumPartitions() < min(slices_, 2 * spark.sparkContext.defaultParallelism):
        table = save(table, "negatives-table").repartition(slices_)  # too few files to keep all cores busy

    def positive_threshold(a: _Anchor, _, step: int) -> int:
        highest = float(np.linalg.norm(a.vector.astype(float))) * longest
        return int(mining.steps[step] * highest) if step < len(mining.steps) else _LOWEST

    def negative_threshold(_, window: tuple, step: int) -> int:
        share = mining.window_steps[step] if step < len(mining.window_steps) else 0
        return max(window[1], int(share * window[2]))

    found = []
    for block in range(blocks):
        asked, by_row = _Round([], True, order), {}
        for r in chosen.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).collect():
            a = _Anchor(r.row, r.id, r.label, np.array(r.vector, np.int64), [])
            by_row[a.row] = a
            if needed := min(mining.positives, r.of_label - 1):
                a.windows = [(0, _LOWEST, _HIGHEST, 0, needed, None, None)]
                asked.anchors.append(a)
        positives = _filled(table, asked, positive_threshold, mining, "positives")
        asked = _Round(list(by_row.values()), False, order)
        for p in (p for df in positives for p in df.select("anchor", "rank", "id", "score").collect()):
            low, high = -(-mining.low * p.score // 100), mining.high * p.score // 100
            if low <= high:
                by_row[p.anchor].windows.append((p.rank, low, high, 0, mining.negatives, p.id, p.score))
        asked.anchors = [a for a in asked.anchors if a.windows]
        found += _filled(table, asked, negative_threshold, mining, "negatives")
    answer = ["anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")]
    if not found:
        names = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return spark.createDataFrame([], names)
    return reduce(DataFrame.unionByName, found).select(*answer)
