"""Ranked search against plain Python over the whole table."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm.lexical import Questions, Search, _packed_unit, _Unit, impact, ranked_search, terms_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in TERM.findall(text or "")]


def plain_search(docs, items, k=50):
    """[(item, rank, id, score)] over lists of (id, text)."""
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counts]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, c in counts for t in c)
    asked: dict = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(plain_terms(text))
    found = []
    for item, terms in asked.items():
        scored = []
        for (i, c), length in zip(counts, lengths):
            m = 50 + 50 * length * n // total if total else 50
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in terms
                if c[t]
            )
            if score > 0 and i is not None:
                scored.append((-score, i))
        found += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found)


def found(spark, docs, items, parts=3, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    q = spark.createDataFrame(items, "item_id long, text string")
    return sorted(tuple(r) for r in ranked_search(d, q, search=Search(**options)).collect())


def test_terms():
    text = "Ab-c_d É 日本 x1\x7f\x00Y'z İ ½"
    assert [t.decode() for t in terms_of(text.encode())] == plain_terms(text)


@pytest.mark.parametrize("options", [{}, {"unit": 16, "seeds": 1, "k": 5}, {"unit": 1, "seeds": 2, "k": 3}, {"block": 40, "k": 7}])
def test_as_plain_search(spark, documents, options):
    docs = [(i, t) for i, t in documents if i is None or len(t or "") < 20000]
    rng = random.Random(5)
    words = [w for _, t in docs[:150] if t for w in t.split()[:40]]
    items = [(i, " ".join(rng.choices(words, k=rng.choice((1, 3, 20))))) for i in range(12)]
    items += [(50, "the THE, the"), (51, None), (52, ""), (53, "nosuchwordanywhere"), (None, "the"), (50, "日本語 x")]
    assert found(spark, docs, items, **options) == plain_search(docs, items, options.get("k", 50))


def test_one_hot_length_with_ties(spark):
    """All documents are one stratum, most score the same: ids decide."""
    rng = random.Random(6)
    docs = [(i, "alpha beta gamma") for i in rng.sample(range(10**6), 300)] + [(10**7 + i, "alpha beta delta") for i in range(100)]
    docs += [(None, "alpha")] * 3 + [docs[0]] * 2
    items = [(1, "gamma beta"), (2, "delta"), (3, "alpha")]
    got = found(spark, docs, items, unit=32, seeds=1, k=20)
    assert got == plain_search(docs, items, 20)


def test_bounds_cover_and_prune():
    """No document of a unit scores more than the bound; the exact score of a lone one is the bound."""
    rng = random.Random(7)
    questions = Questions([(item, term) for item in range(6) for term in rng.sample([b"a", b"b", b"c", b"d", b"e"], 3)])
    questions.weight[:] = [rng.randint(1, 9000) for _ in questions.vocabulary]
    for size in (1, 1, 7, 40):
        docs = []
        for i in range(size):
            terms = np.array(rng.sample(range(5), rng.randint(1, 5)), np.int32)
            docs.append((i, terms.tobytes(), np.array([rng.randint(1, 9) for _ in terms], np.int32).tobytes()))
        *lists, top_term, top_tf = _packed_unit(docs)
        unit = _Unit(80, list(range(size)), *lists)
        tops = impact(np.frombuffer(top_tf, np.int32).astype(np.int64), 80)
        bound = questions.bounds(np.frombuffer(top_term, np.int32), tops)
        for item in range(6):
            terms = questions.terms(item)
            best = unit.best(terms, questions.weight[terms], 1, 1)
            score = best[0][1] if best else 0
            assert score == bound[item] if size == 1 else score <= bound[item]


def test_empty_sides_and_clashing_columns(spark):
    docs, items = [(1, "a b"), (2, None)], [(1, "a")]
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [(1, None)], items) == []
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("z") for c in ("id", "n", "m", "term", "row", "score")})
    q = spark.createDataFrame([("q", "a"), (None, "b")], "item_id string, text string").withColumn("item", F.lit(1)).withColumn("term", F.lit(2))
    assert [tuple(r) for r in ranked_search(d, q).collect()] == [("q", *plain_search(docs, items)[0][1:])]


def test_very_long_text(spark):
    docs = [(1, "needle " + "hay " * 300000), (2, "needle hay"), (3, "hay " * 200000 + "needle")]
    assert found(spark, docs, [(1, "needle hay")]) == plain_search(docs, [(1, "needle hay")])
