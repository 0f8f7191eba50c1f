"""Token counts and packing against the tokenizer library on whole texts."""

from __future__ import annotations

import random
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tideline.llm.common import classes, piece_tokens, split_text, tokenizer
from tideline.llm.packing import fill, hilbert_key, pack
from tideline.llm.queries import tokenizer_path
from tideline.llm.tokens import count_tokens, frequent_pre_tokens

BYTE_BPE, WORD_BPE = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")


@pytest.mark.parametrize("frequent,cached", [(32_768, 100_000), (1, 3)])
def test_token_counts_are_the_library_s(spark, documents, documents_df, frequent, cached):
    library = Tokenizer.from_file(BYTE_BPE)
    counted = count_tokens(documents_df, BYTE_BPE, frequent=frequent, cached=cached)
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in counted.collect()), key=str)
    want = []
    for key, text in documents:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((key, len((text or "").encode()), n, n > 1024))
    assert got == sorted(want, key=str)


def test_token_counts_on_empty_and_clashing_columns(spark):
    docs = spark.createDataFrame([("a b", 1, 2)], "text string, n_tokens int, text_to_count int")
    row = count_tokens(docs, BYTE_BPE).first()
    assert (row.n_tokens, row.text_to_count) == (2, 2)
    assert count_tokens(docs.limit(0), BYTE_BPE).count() == 0


def test_frequent_pre_tokens_over_many_parts(spark):
    docs = spark.createDataFrame([(f"the the x{i} the",) for i in range(100)], "text string").repartition(40)
    assert frequent_pre_tokens(docs, "text", BYTE_BPE, 5)[0] == " the"


def test_packed_pieces_round_trip(spark, documents, documents_df):
    library = Tokenizer.from_file(WORD_BPE)
    want = sorted(
        (str(key), tuple(library.encode(text or "", add_special_tokens=False).ids + [1])) for key, text in documents
    )
    sequences, texts = defaultdict(list), defaultdict(list)
    for r in pack(documents_df, WORD_BPE, parts=3).collect():
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length > 0
        assert zlib.crc32(bytes(r.ids)) >= 0
        sequences[r.sequence_id].append((r.offset, r.length))
        texts[(str(r.id), r.doc_tokens)].append((r.start, tuple(ids.tolist())))
    padded = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
        padded += 0 if at & (at - 1) == 0 else 2048 - at
    assert padded == 0
    got = []
    for (key, size), pieces in texts.items():
        # Documents without an id, or repeated ones, share a name: take whole runs of pieces.
        while pieces:
            at, ids = 0, ()
            while at < size:
                piece = next(p for p in pieces if p[0] == at)
                pieces.remove(piece)
                at, ids = at + len(piece[1]), ids + piece[1]
            got.append((key, ids))
    assert sorted(got) == want


def test_pack_of_nothing(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), WORD_BPE).count() == 0
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([], "doc_id long, text string"), WORD_BPE, size=1000)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=30), st.sampled_from([8, 16, 64]))
def test_fill_cuts_without_gaps_or_padding(lengths, size):
    pieces = list(fill(iter(enumerate(lengths)), size))
    used, seen = defaultdict(int), defaultdict(int)
    for doc, start, length, sequence, offset in pieces:
        assert length > 0 and start == seen[doc] and offset == used[sequence]
        seen[doc] += length
        used[sequence] += length
    assert [seen[i] for i in range(len(lengths))] == lengths
    assert all(n <= size and n & (n - 1) == 0 for n in used.values())
    assert sorted(used) == list(range(len(used)))


@pytest.mark.parametrize("d,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_neighbours_are_one_step_apart(d, bits):
    points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d), -1).reshape(-1, d)
    keys = hilbert_key(points, bits)
    assert sorted(keys) == list(range(1 << (d * bits)))
    assert np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(1).max() == 1


def test_likes_lie_together(spark):
    """Copies of two texts, a third of all rows each, end up in runs of their own."""
    rows = [(i, "alpha beta gamma " * 20 if i % 2 else "one two three four " * 20) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    pieces = sorted(pack(docs, WORD_BPE, parts=4).collect(), key=lambda r: (r.sequence_id, r.offset))
    kinds = [r.id % 2 for r in pieces]
    assert sum(a != b for a, b in zip(kinds, kinds[1:])) <= 8


WILD = "aΣσé\u0301’ 1²½日本текст\u200b\u2003\t'İß\u0378🙂\x85Ⅷ٣"


@pytest.mark.parametrize("path,by_word", [(BYTE_BPE, False), (WORD_BPE, True)])
def test_pre_tokens_of_all_scripts(path, by_word):
    """Pieces looked up one by one give what the library gives for the whole text."""
    rng = random.Random(7)
    found, library = classes(path), tokenizer(path)
    assigned = [c for c in map(chr, range(0x20000)) if unicodedata.category(c) not in ("Cs", "Cn")]
    texts = ["".join(rng.choice(WILD) for _ in range(12)) for _ in range(3000)]
    texts += ["".join(rng.choice(assigned) if rng.random() < 0.4 else rng.choice("ab 1'.\n") for _ in range(40)) for _ in range(3000)]
    texts += ["".join(rng.choice("abc é’— “x” °…текст 12'\n") for _ in range(60)) for _ in range(500)]
    sure = [(t, split_text(t, found, by_word)) for t in texts]
    sure = [(t, pieces) for t, pieces in sure if pieces is not None]
    assert len(sure) > 500 and all(pieces is not None for t, pieces in [(t, split_text(t, found, by_word)) for t in texts[-500:]])
    whole = library.encode_batch([t for t, _ in sure], add_special_tokens=False)
    for (text, pieces), encoded in zip(sure, whole):
        assert [t.id for piece in pieces for t in piece_tokens(piece, path)] == encoded.ids, text


def test_typographic_texts_do_not_go_to_the_library_whole(spark):
    text = "It’s — “quoted” … £5 at 20 °C, цена 日本 été"
    docs = spark.createDataFrame([(i, f"{text} {i}") for i in range(50)], "doc_id long, text string")
    assert " —" in frequent_pre_tokens(docs, "text", BYTE_BPE, 50)
    counts = {r.doc_id: r.n_tokens for r in count_tokens(docs, BYTE_BPE).collect()}
    assert counts == {i: len(tokenizer(BYTE_BPE).encode(f"{text} {i}", add_special_tokens=False).ids) for i in range(50)}
