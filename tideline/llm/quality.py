"""A quality classifier on document statistics: random Fourier features, ridge, isotonic calibration."""

from __future__ import annotations

import math
import operator
import string
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import raw_bytes, release, save, slices, text_of
from tideline.llm.rules import CLASSES, WHITE, class_counts

STATISTICS = (
    "log_words", "log_word_length", "word_length_spread", "distinct_words", "short_words", "long_words",
    "follows_itself", "bare_punctuation", "ends_in_punctuation", "capitalised", "repeated_lines",
    "words_per_line", "byte_entropy", *[f"share_{c}" for c in CLASSES],
)
FOURIER = 128
# Labelled sums that one merging task takes.
FAN_IN = 8
FOLDS = 2
BINS = 512
_PUNCTUATION = string.punctuation.encode()
_ENDS = frozenset(_PUNCTUATION)


def statistics(text: bytes) -> list[float]:
    """The values of ``STATISTICS``; all 0 for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [line for line in text.split(b"\n") if line.strip(WHITE)]
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) / len(text)
    shares = shares[shares > 0]
    classes = class_counts(text)
    return [
        math.log1p(n),
        math.log1p(lengths.mean()),
        float(lengths.std() / lengths.mean()),
        # Of many words fewer are distinct: the power holds long texts against short ones.
        math.log(len(set(words))) / math.log(n) if n > 1 else 1.0,
        float((lengths <= 3).mean()),
        float((lengths >= 12).mean()),
        sum(map(operator.eq, words, islice(words, 1, None))) / n,
        sum(not word.translate(None, _PUNCTUATION) for word in words) / n,
        sum(word[-1] in _ENDS for word in words) / n,
        sum(word[0] < 91 and word[:1].isupper() for word in words) / n,
        1 - len(set(lines)) / len(lines),
        math.log1p(n / len(lines)),
        float(-(shares * np.log2(shares)).sum()),
        *(classes / classes.sum()).tolist(),
    ]


def text_statistics(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(id, statistics array<float>) of each whole text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in slices(batches):
            values = pa.array([statistics(t) for t in raw_bytes(batch.column(1))], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["id", "statistics"])

    rows = docs.select(F.col(f"`{id_column}`").alias("id"), text_of(text))
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {id_type}, statistics array<float>")


def is_held_out(id_column: Column, of: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id is not held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % of == fold, F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, len(STATISTICS))


@dataclass
class Features:
    """Standardised statistics, mapped to cosines of random directions (a Gaussian kernel)."""

    mean: np.ndarray
    spread: np.ndarray
    seed: int

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        width = math.sqrt(len(STATISTICS))
        self.directions = rng.standard_normal((len(STATISTICS), FOURIER)) / width
        self.phases = rng.uniform(0, 2 * math.pi, FOURIER)

    def of(self, values: np.ndarray) -> np.ndarray:
        z = np.clip((values - self.mean) / self.spread, -6, 6)
        cosines = math.sqrt(2 / FOURIER) * np.cos(z @ self.directions + self.phases)
        return np.hstack([cosines, np.ones((len(z), 1))])


@dataclass
class Model:
    """Scores of statistics. Without labelled rows there are no features, and every score is 1."""

    features: Features | None = None
    weights: np.ndarray | None = None
    raw: np.ndarray | None = None
    calibrated: np.ndarray | None = None

    def scores(self, values: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.ones(len(values))
        return np.interp(self.features.of(values) @ self.weights, self.raw, self.calibrated)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the knots (block centres and means) of the rising fit of y on sorted x."""
    blocks: list[list[float]] = []
    for xi, yi, wi in zip(x, y, weight):
        blocks.append([xi * wi, yi * wi, wi])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    done = np.array(blocks)
    return done[:, 0] / done[:, 2], done[:, 1] / done[:, 2]


def _sums(train: DataFrame, features: Features) -> np.ndarray:
    """For each fold the sums Z'Z, Z'y over the rows outside and inside: one packed row per
    partition, added as a tree; the driver gets one."""
    size = FOURIER + 2
    shape = (FOLDS, size, size)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            z = features.of(_matrix(batch.column("statistics")))
            z = np.hstack([z, batch.column("label").to_numpy(zero_copy_only=False)[:, None]])
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            for f in range(FOLDS):
                total[f] += z[fold == f].T @ z[fold == f]
        yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                total += np.frombuffer(blob).reshape(shape)
        yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    summed, parts = train.mapInArrow(part, "sums binary"), train.rdd.getNumPartitions()
    while parts > 1:
        parts = -(-parts // FAN_IN)
        summed = summed.repartition(parts).mapInArrow(add, "sums binary")
    return sum((np.frombuffer(bytes(r.sums)).reshape(shape) for r in summed.collect()), np.zeros(shape))


def _ridge(sums: np.ndarray, penalty: float) -> np.ndarray:
    """Weights from the summed normal equations; the constant (before the label) is not penalised."""
    n = sums[-2, -2]
    penalties = np.full(len(sums) - 1, penalty * max(n, 1.0))
    penalties[-1] = 1e-9
    return np.linalg.solve(sums[:-1, :-1] + np.diag(penalties), sums[:-1, -1])


def fit(values: DataFrame, labels: DataFrame, penalty: float = 1e-4, seed: int = 11) -> Model:
    """Fit on the rows of ``values`` (id, statistics) that ``labels`` (id, label 0 or 1) has.

    All labelled rows count; rows that are held out (``is_held_out``) or have a null label never
    do. Statistics are standardised by the labelled rows. The normal equations are summed within
    partitions, so one small matrix per partition moves. Scores for the calibration come from the
    model of the other fold; they are counted in bins of 1 / ``BINS``, and the rising fit through
    the bins is made on the driver.
    """
    labelled = labels.where(F.col("label").isNotNull() & ~is_held_out(F.col("id")))
    train = values.join(labelled.select("id", F.col("label").cast("double").alias("label")), "id")
    train = train.withColumn("fold", (F.pmod(F.xxhash64("id"), F.lit(FOLDS))).cast("int"))
    train = save(train.select("statistics", "label", "fold"), "quality-train")
    columns = [F.col("statistics")[i].cast("double") for i in range(len(STATISTICS))]
    stats = train.agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(c) for c in columns]).alias("mean"),
        F.array(*[F.stddev_pop(c) for c in columns]).alias("spread"),
    ).first()
    if not stats.n:
        return Model()
    spread = np.array(stats.spread)
    features = Features(np.array(stats.mean), np.where(spread > 1e-6, spread, 1.0), seed)
    sums = _sums(train, features)
    whole = sums.sum(0)
    weights = _ridge(whole, penalty)
    others = [_ridge(whole - s, penalty) if (whole - s)[-2, -2] else weights for s in sums]

    def out_of_fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, fold = features.of(_matrix(batch.column("statistics"))), batch.column("fold").to_numpy()
            raw = np.stack([z @ w for w in others], 1)[np.arange(len(z)), fold]
            bins = np.clip(np.floor(raw * BINS), -BINS, 2 * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("label")], names=["bin", "label"])

    binned = train.mapInArrow(out_of_fold, "bin bigint, label double").groupBy("bin")
    rows = sorted(binned.agg(F.avg("label").alias("rate"), F.count(F.lit(1)).alias("n")).collect())
    centres = np.array([(r.bin + 0.5) / BINS for r in rows])
    raw, calibrated = isotonic(centres, np.array([r.rate for r in rows]), np.array([float(r.n) for r in rows]))
    return Model(features, weights, raw, calibrated)


def score(values: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """(id, statistics) to (id, held_out, score, predicted)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["id", "score"])

    id_type = values.schema["id"].dataType.simpleString()
    scored = values.mapInArrow(work, f"id {id_type}, score double")
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select("id", is_held_out(F.col("id")).alias("held_out"), "score", predicted.alias("predicted"))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    threshold: float = 0.7,
) -> tuple[DataFrame, Model]:
    """Fit on the labelled documents and score all: (id, held_out, score, predicted), and the model.

    Texts are read once; what moves by id are their ``STATISTICS``. A null or empty text has
    statistics of 0 and the score that the model gives those. Ids that repeat, in documents or
    labels, count once for each pair; a null id meets no label. Without labelled rows every score
    is 1: nothing is rejected unseen. An empty table gives an empty table. Other columns are not read.
    """
    values = save(text_statistics(docs, id_column, text), "quality-statistics")
    known = labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").alias("label"))
    model = fit(values, known)
    return score(values, model, threshold), model


def accepted(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with all their columns. No shuffle.

    Each text goes to a Python worker once, and only the verdict comes back.
    """

    @F.arrow_udf("boolean")
    def accepts(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for batch in texts:
            verdicts = []
            for at in range(0, len(batch), 512):
                values = [statistics(t) for t in raw_bytes(batch.slice(at, 512))]
                scores = model.scores(np.array(values, np.float32).astype(np.float64).reshape(-1, len(STATISTICS)))
                verdicts.extend((scores >= threshold).tolist())
            yield pa.array(verdicts, pa.bool_())

    return docs.where(accepts(text_of(text)))
