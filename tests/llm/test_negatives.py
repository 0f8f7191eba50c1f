"""Hard negatives against all pairs in plain Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm.negatives import Mining, _Anchor, _Lists, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_rows(rows):
    """(id, label, whole numbers) of the rows that take part."""
    made = []
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        if all(abs(x) < 65536 for x in vector):
            made.append((i, label, whole))
    return made


def plain_negatives(rows, positives=5, negatives=10):
    rows, found = plain_rows(rows), []
    for at, (i, label, vector) in enumerate(rows):
        if i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v)), j, n) for n, (j, _, v) in enumerate(rows) if n != at]
        same = sorted(s for s in scored if rows[s[2]][1] == label)[:positives]
        other = sorted(s for s in scored if rows[s[2]][1] != label)
        for p, positive, _ in same:
            inside = [s for s in other if 30 * -p <= 100 * -s[0] <= 90 * -p][:negatives]
            found += [(i, positive, rank, j, -p, -s) for rank, (s, j, _) in enumerate(inside, 1)]
    return sorted(found)


def found(spark, rows, mining=Mining()):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hard_negatives(df, F.col("vec_id") % 100 == 0, mining=mining).collect())


def vectors(n, dimensions, labels, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dimensions))
    label = rng.integers(0, labels, n)
    made = rng.normal(size=(n, dimensions)) * spread + centres[label]
    made /= np.linalg.norm(made, axis=1, keepdims=True)
    return [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(made, label))]


@pytest.mark.parametrize(
    "mining",
    [
        Mining(),
        Mining(rows=37, chunk=3, block=2),
        Mining(rows=64, chunk=1, steps=(0.95, 0.9), window_steps=(0.99, 0.98, 0.95)),
        Mining(rows=50, steps=(), window_steps=(), positives=2, negatives=3),
    ],
)
def test_as_all_pairs(spark, mining):
    for spread, seed in ((0.4, 1), (3.0, 2)):
        rows = vectors(450, 12, 4, seed, spread)
        assert found(spark, rows, mining) == plain_negatives(rows, mining.positives, mining.negatives)


def test_nulls_odd_values_ties_and_short_vectors(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice((-0.5, 0.0, 0.5, 1.0)) for _ in range(rng.choice((0, 2, 4)))], rng.randrange(3)) for i in range(240)]
    rows += [(300, None, 1), (400, [0.5, None], 1), (500, [1.0, 1.0], None), (None, [1.0, 1.0], 1)]
    rows += [(600, [math.nan, 1.0], 1), (700, [math.inf], 1), (800, [1e30], 1), (900, [70000.0, 1.0], 2), (1000, [60000.0, 1.0], 2)]
    rows += [(1001, [1.0, 1.0, 1.0, 1.0], 9), (1100, [1.0, 1.0, 1.0, 1.0], 8)]  # labels of one row
    rows += [(1200, [-1.0, -1.0], 7), (1201, [1.0, 1.0], 7), (1300, [0.0, 0.0], 1)]
    assert found(spark, rows) == plain_negatives(rows)
    assert found(spark, rows, Mining(rows=16, chunk=2, block=3)) == plain_negatives(rows)


def test_repeated_rows_are_rows_of_their_own(spark):
    rows = vectors(60, 6, 3, 4)
    rows += [rows[0]] * 2 + [rows[7]] * 25
    assert found(spark, rows) == plain_negatives(rows)


def test_empty_sides_and_clashing_columns(spark):
    rows = vectors(30, 4, 2, 5)
    assert found(spark, []) == [] and found(spark, [(i + 1, v, k) for i, v, k in rows]) == []
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "row", "vector", "anchor", "score")})
    got = hard_negatives(df, F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows)
    text = hard_negatives(df, F.col("vec_id") % 100 == 0, label=F.concat(F.lit("l"), "label")).collect()
    assert sorted(map(tuple, text)) == plain_negatives(rows)


def test_lists_omit_and_drop_only_what_cannot_reach():
    rng = np.random.default_rng(6)
    vectors_ = (rng.normal(size=(200, 16)) * np.linspace(300, 5, 16)).astype(np.int64)
    numbers = np.arange(200)
    anchor = _Anchor(3, 3, "a", vectors_[3], [])
    scores = vectors_ @ vectors_[3]
    for share in (0.05, 0.3, 0.6, 0.9, -1):
        threshold = int(share * scores[3])
        least = (threshold - 0.5) / np.linalg.norm(vectors_[3].astype(float))
        lists = _Lists(numbers, numbers, ["a"] * 200, vectors_, np.arange(16), 4, least)
        at, score = lists.reaching(anchor, True, threshold)
        got = dict(zip(lists.rows[at].tolist(), score.tolist()))
        assert got == {i: int(s) for i, s in enumerate(scores) if s >= threshold and i != 3}
        if share > 0.2:
            assert sum(lists.listed) < 4 * 200
