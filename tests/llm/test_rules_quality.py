"""Quality rules against plain Python, the classifier by its held-out accuracy."""

from __future__ import annotations

import math
import re
import string
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.llm import quality, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_base(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def plain_distance(p, q):
    keys, p_all, q_all = set(p) | set(q), sum(p.values()), sum(q.values())
    total = 0.0
    for k in keys:
        a, b = p.get(k, 0) / p_all, q.get(k, 0) / q_all
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
    return math.sqrt(max(0, total / 2))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "a b c d e f g h", "\n", " ", "#x", "é|", "\t"]), max_size=60))
def test_base_counts(parts):
    text = " ".join(parts)
    assert rules.base_counts(text.encode(), text.encode().split()) == plain_base(text)


def test_rules_against_brute_force(spark, documents):
    rows = [(key, text, lang) for (key, text), lang in zip(documents, ["en", "de", "en", None, "xx"] * len(documents))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = sorted((tuple(r) for r in rules.quality_rules(docs).drop("lang").collect()), key=str)
    words, classes = {}, {}
    names = dict(enumerate(rules.CLASSES))
    for _, text, lang in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words.setdefault(lang or "", Counter()).update(WORD.findall(lowered))
        classes.setdefault(lang or "", Counter()).update(
            {names[i]: int(n) for i, n in enumerate(rules.class_counts((text or "").encode()))}
        )
    every = sum(sum(c.values()) for c in words.values())
    limits, want = rules.Limits(), []
    for key, text, lang in rows:
        base = plain_base(text)
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        by_class = by_word = None
        if base[0] >= limits.guard_words and base[1] >= limits.guard_chars:
            own = words[lang or ""]
            assert sum(own.values()) >= 0.001 * every
            common = {w: n for w, n in own.items() if n >= 0.002 * sum(own.values())}
            lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            mine = Counter(w if w in common else None for w in WORD.findall(lowered))
            reference = {**common, None: max(1, sum(own.values()) - sum(common.values()))}
            by_word = plain_distance(mine, reference)
            by_class = plain_distance(
                {names[i]: int(n) for i, n in enumerate(rules.class_counts(text.encode()))}, classes[lang or ""]
            )
        far = by_class is not None and limits.too_far(base[0], by_class, by_word)
        want.append((key, *base, failed, by_class, by_word, not failed and not far))
    want.sort(key=str)
    assert [r[:7] + r[9:] for r in got] == [r[:7] + r[9:] for r in want]
    for g, w in zip(got, want):
        for i in (7, 8):
            assert (g[i] is None) == (w[i] is None)
            assert g[i] is None or abs(g[i] - w[i]) < 1e-4


def test_class_counts_cover_all_characters():
    text = "aÉß中́1½.#| \n\t\x07🙂"
    counts = dict(zip(rules.CLASSES, rules.class_counts(text.encode())))
    assert counts == {
        "lower": 2, "upper": 1, "letter": 1, "mark": 1, "number": 2, "prose": 1, "symbol": 3, "space": 3, "control": 1,
    }


def test_junk_goes_and_clean_stays(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = rules.quality_rules(docs).join(labels, "doc_id")
    judged = judged.withColumn("verdict", F.col("kept").cast("int"))
    rates = {r.quality: r.kept for r in judged.where("not base_failed").groupBy("quality").agg(F.avg("verdict").alias("kept")).collect()}
    assert rates[1] > 0.97 and rates.get(0, 0) < 0.1


def test_rules_on_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, kept int, lang_to_judge int")
    found = rules.quality_rules(docs)
    assert found.count() == 0 and found.columns.count("kept") == 1
    alone = spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")
    assert rules.quality_rules(alone).first().kept is False


def test_isotonic():
    x, y = quality.isotonic(np.arange(5.0), np.array([0.1, 0.5, 0.3, 0.2, 0.9]), np.ones(5))
    assert np.allclose(y, [0.1, 1 / 3, 0.9]) and np.allclose(x, [0, 2, 4])


def test_classifier_by_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored, model = quality.classify(docs, labels)
    rows = scored.join(labels.withColumnRenamed("doc_id", "id"), "id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    # Labels of held-out rows change nothing.
    flipped = labels.withColumn(
        "quality", F.when(quality.is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    again = {r.id: r.score for r in quality.classify(docs, flipped)[0].collect()}
    assert all(abs(again[r.id] - r.score) < 1e-6 for r in rows)
    kept = {r.doc_id for r in quality.accepted(docs, model).collect()}
    assert kept == {r.id for r in scored.collect() if r.predicted}


def plain_statistics(text: str) -> list[float]:
    """One text's statistics, each from its definition."""
    data = text.encode()
    words = [w for w in re.split(rb"[ \t-\r]+", data) if w]
    if not words:
        return [0.0] * len(quality.STATISTICS)
    n, sizes = len(words), [len(w) for w in words]
    mean = sum(sizes) / n
    lines = [line for line in data.split(b"\n") if re.search(rb"[^ \t-\r]", line)]
    shares = [c / len(data) for c in Counter(data).values()]
    marks = set(string.punctuation.encode())
    classes = rules.class_counts(data)
    return [
        math.log(1 + n), math.log(1 + mean), math.sqrt(sum((s - mean) ** 2 for s in sizes) / n) / mean,
        math.log(len(set(words))) / math.log(n) if n > 1 else 1.0,
        sum(s <= 3 for s in sizes) / n, sum(s >= 12 for s in sizes) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
        sum(set(w) <= marks for w in words) / n, sum(w[-1] in marks for w in words) / n,
        sum(65 <= w[0] <= 90 for w in words) / n, 1 - len(set(lines)) / len(lines), math.log(1 + n / len(lines)),
        -sum(s * math.log2(s) for s in shares), *[c / sum(classes) for c in classes],
    ]


def plain_scores(docs: list[tuple], labels: dict) -> dict:
    """The whole method on whole matrices, in one process."""
    ids = [i for i, _ in docs]
    values = np.array([plain_statistics(t or "") for _, t in docs], np.float32).astype(float)
    train = [k for k, i in enumerate(ids) if labels.get(i) is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    y = np.array([labels[ids[k]] for k in train], float)
    spread = values[train].std(axis=0)
    spread[spread <= 1e-6] = 1.0
    rng = np.random.default_rng(11)
    directions = rng.standard_normal((values.shape[1], quality.FOURIER)) / math.sqrt(values.shape[1])
    phases = rng.uniform(0, 2 * math.pi, quality.FOURIER)
    z = np.clip((values - values[train].mean(axis=0)) / spread, -6, 6) @ directions + phases
    z = np.column_stack([math.sqrt(2 / quality.FOURIER) * np.cos(z), np.ones(len(z))])

    def ridge(rows: list[int]) -> np.ndarray:
        # Least squares of the rows, and of one more for each feature that pulls its weight to 0.
        pull = np.sqrt([1e-4 * len(rows)] * quality.FOURIER + [1e-9])
        left = np.vstack([z[[train[r] for r in rows]], np.diag(pull)])
        return np.linalg.lstsq(left, np.append(y[rows], np.zeros(len(pull))), rcond=None)[0]

    fold = np.array([xxhash.xxh64_intdigest(struct.pack("<q", ids[k]), seed=42) % 2 for k in train])
    raw = np.zeros(len(train))
    for f in (0, 1):
        weights = ridge([r for r in range(len(train)) if fold[r] != f])
        raw[fold == f] = (z[train] @ weights)[fold == f]
    bins = np.clip(np.floor(raw * quality.BINS), -quality.BINS, 2 * quality.BINS)
    at = sorted(set(bins))
    rate, weight = np.array([y[bins == b].mean() for b in at]), np.array([(bins == b).sum() for b in at])
    centre = (np.array(at) + 0.5) / quality.BINS
    # The rising fit by its definition: the largest over starts of the smallest over ends of the mean.
    means = lambda a, b: np.average(rate[a : b + 1], weights=weight[a : b + 1])
    rising = np.array([max(min(means(a, b) for b in range(i, len(at))) for a in range(i + 1)) for i in range(len(at))])
    knots = [np.isclose(rising, v) for v in sorted(set(np.round(rising, 12)))]
    x = [np.average(centre[k], weights=weight[k]) for k in knots]
    final = np.interp(z @ ridge(list(range(len(train)))), x, [rising[k][0] for k in knots])
    return dict(zip(ids, final))


def test_classifier_beside_whole_matrices(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] + [(10**6, None), (10**6 + 1, "\n")]
    want = plain_scores(texts, {r.doc_id: r.quality for r in labels.collect()})
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    got = {r.id: r.score for r in quality.classify(df, labels)[0].collect()}
    assert set(got) == set(want)
    assert max(abs(got[i] - want[i]) for i in got) < 1e-4
    assert len({round(v, 3) for v in want.values()}) > 20


def test_classifier_without_labels_and_on_odd_rows(spark, documents_df):
    none = spark.createDataFrame([], "doc_id long, quality int")
    scored, _ = quality.classify(documents_df, none)
    assert {r.score for r in scored.collect()} == {1.0}
    known = spark.createDataFrame([(0, 1), (1, 1), (3, None), (None, 0)], "doc_id long, quality int")
    scored, model = quality.classify(documents_df, known)
    assert scored.count() == documents_df.count()
    extra = documents_df.withColumn("text_to_score", F.lit(1)).withColumn("score", F.lit("s"))
    assert quality.accepted(extra, model).columns == extra.columns
    assert quality.classify(documents_df.limit(0), known)[0].count() == 0


@pytest.mark.parametrize("text", ["", " \n", "a", "\u0000", "🙂" * 3])
def test_statistics_are_finite(text):
    values = quality.statistics(text.encode())
    assert len(values) == len(quality.STATISTICS) and np.isfinite(values).all()
