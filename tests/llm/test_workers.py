"""Python workers are used again: what a step leaves in one must not add to what the next one needs."""

from __future__ import annotations

import gc

import pyarrow as pa
import pytest

from tideline.llm import neardup, packing, quality
from tideline.llm.common import PieceCache, tokenizer
from tideline.llm.queries import tokenizer_path

WORD_BPE = tokenizer_path("word_bpe_49k.json")


def cached() -> int:
    return sum(len(o) for o in gc.get_objects() if isinstance(o, PieceCache))


@pytest.fixture
def full():
    """This process as a worker that a packing step has used."""
    packing.text_ids("some words that a worker keeps", WORD_BPE, packing.classes(WORD_BPE))
    assert cached() > 0 and tokenizer.cache_info().currsize > 0


@pytest.fixture
def works(spark, monkeypatch):
    """What would run in the workers, instead of the steps themselves."""
    made = []
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda df, work, schema: made.append(work) or df)
    real = quality.F.arrow_udf
    monkeypatch.setattr(quality.F, "arrow_udf", lambda kind: lambda work: made.append(work) or real(kind)(work))
    return made


def test_steps_after_packing_drop_its_caches(spark, full, works):
    docs = spark.createDataFrame([(1, "a b c")], "id long, text string")
    texts = pa.array(["a b c d e f", None, ""]).fill_null("")
    rows = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), texts], names=["id", "text"])
    quality.text_statistics(docs, "id", "text")
    quality.accepted(docs, quality.Model())
    neardup._profiles(docs, neardup.Join())
    assert len(works) == 3
    for work, given in zip(works, (rows, texts, rows)):
        packing.text_ids("some words", WORD_BPE, packing.classes(WORD_BPE))
        assert cached() > 0
        assert sum(len(made) for made in work(iter([given]))) == 3
        assert cached() == 0 and tokenizer.cache_info().currsize == 0


def test_one_cache_at_a_time(full):
    packing.text_ids("other words", WORD_BPE, packing.classes(WORD_BPE), limit=10)
    assert cached() == 2


def test_shingles_keep_no_words():
    before = cached()
    neardup.shingles(b" ".join(b"word%d" % i for i in range(5000)), 5)
    assert cached() == before


def test_accepted_texts_are_not_sent_back(spark):
    rows = [(i, t) for i, t in enumerate(["a b c", None, "", "x " * 3000] * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = quality.accepted(docs, quality.Model())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan
    assert sorted(map(tuple, found.collect())) == sorted(rows)
    assert quality.accepted(docs, quality.Model(), threshold=2.0).count() == 0
