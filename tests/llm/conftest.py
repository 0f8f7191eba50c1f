from __future__ import annotations

import pytest

from tideline.llm.common import ship


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def documents(spark, sf):
    """(doc_id, text) of the small test data with texts that need care."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    odd = [
        None, "", " ", "\n\n", "a", "  two  spaces ", "tab\tand\r\nbreak\n\n x", "don't we'll I'M", "naïve Ünïcode ß É", "x\u00a0y\u2003z",
        "\x1c\x1d sep \x85", "<|endoftext|>", "a <|startoftext|> b<|ENDOFTEXT|>", "日本語 текст عربى", "é e\u0301 İstanbul ΣΑΣ", "½ ² 3.14 1234567",
        "🙂🙂 emoji", "K Å", "word " * 30000, "x" * 20000, "!" * 300, "a\u0000b",
    ]
    return rows + [(10**6 + i, t) for i, t in enumerate(odd)] + [(None, "no id"), (None, None), rows[0], rows[0]]


@pytest.fixture(scope="session")
def documents_df(spark, documents):
    return spark.createDataFrame(documents, "doc_id long, text string").repartition(5)
