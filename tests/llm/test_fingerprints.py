"""Piecewise hashing: signatures and edit distances against plain Python, neighbours against a plain loop."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tideline.llm import fingerprints as fp
from tideline.llm.fingerprints import edit_distances, fingerprint, fingerprints, likenesses


def plain_fingerprint(text: bytes) -> str:
    """Byte by byte."""

    def low_zeros(end: int) -> int:
        value = 0
        for i in range(end - 7, end):
            value = (value * 0x01000193 + (text[i] if i >= 0 else 0)) % 2**32
        value = (value ^ (value >> 15)) * 0x2C1B3C6D % 2**32
        value ^= value >> 13
        return (value & -value).bit_length() - 1 if value else 32

    zeros = [low_zeros(end) for end in range(1, len(text) + 1)]

    def signature(level: int) -> str:
        made, start = "", 0
        for end in range(1, len(text) + 1):
            if end == len(text) or (zeros[end - 1] >= level and level <= 31):
                made += fp.ALPHABET[xxhash.xxh3_64_intdigest(text[start:end]) % 64]
                start = end
        return made

    level = 2
    while len(signature(level)) > 64:
        level += 1
    return f"{level}:{signature(level)}:{signature(level + 1)}"


def plain_distance(a: bytes, b: bytes) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


def plain_rows(rows: list[tuple]) -> list[tuple]:
    """Verdicts of distinct (id, text) rows with distinct ids."""
    found = []
    texts = [(i, t or "") for i, t in sorted(rows, key=lambda r: -r[0])]
    for at, (i, text) in enumerate(texts):
        following = texts[(at + 1) % len(texts)][1]
        third = len(text) // 3
        changed = (text[: len(text) - third] + following[:third]).encode()
        own, other, mark = (plain_fingerprint(t) for t in (text.encode(), following.encode(), changed))
        near = [float(x) for x in likenesses([(own, mark), (own, other)])]
        found.append((i, len(text), hashlib.sha256(changed).hexdigest(), own, mark, *near))
    return sorted(found)


def test_fingerprints_as_byte_by_byte(monkeypatch):
    rng = random.Random(1)
    texts = [bytes(rng.choices(b"abcdefgh \n", k=n)) for n in (1, 2, 6, 7, 8, 30, 300, 3000)]
    texts += [b"", "héé 日本語 ".encode() * 50, b"a" * 5000, b"\0" * 500, b"word " * 900]
    assert [fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    assert all(len(fingerprint(t).split(":")[1]) <= 64 for t in texts)
    monkeypatch.setattr(fp, "PIECE", 64)  # long texts go piece by piece
    assert [fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_edit_distances_as_by_table():
    rng = random.Random(2)
    words = [bytes(rng.choices(b"abcd", k=rng.choice((1, 2, 5, 31, 63, 64)))) for _ in range(300)]
    pairs = list(zip(words, words[1:] + words[:1]))
    pairs += [(w, w[:20] + b"x" + w[25:]) for w in words if len(w) > 30]
    left, right = map(list, zip(*pairs))
    assert edit_distances(left, right).tolist() == [plain_distance(a, b) for a, b in pairs]


def test_likeness():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9)))
    texts = [" ".join(word() for _ in range(n)) for n in (100, 400, 3000) for _ in range(20)]
    marks = [fingerprint(t.encode()) for t in texts]
    changed = [fingerprint(fp.edited(t, u).encode()) for t, u in zip(texts, texts[1:] + texts[:1])]
    near = likenesses(list(zip(marks, changed)))
    apart = likenesses(list(zip(marks, marks[1:] + marks[:1])))
    assert near.min() > 0.4 and np.median(near) > 0.55 and apart.max() == 0
    empty = fingerprint(b"")
    assert likenesses([(empty, empty), (empty, marks[0]), (marks[0], marks[0])]).tolist() == [1, 0, 1]
    assert likenesses([("2:AAAAAAA:AA", "2:AAA:A")])[0] == 1.0  # runs are cut to three
    assert likenesses([("2:ABCDEFGH:AB", "4:ABCDEFGH:AB"), ("2:ABCDEFGH:XYXYX", "3:XYXYX:AB")]).tolist() == [0, 1]


def verdicts(df):
    return sorted(tuple(r) for r in fingerprints(df).collect())


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_neighbours_as_in_a_plain_loop(spark, documents, parts):
    rows = list({i: (i, t) for i, t in documents if i is not None and len(t or "") < 9000}.values())[-90:]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert verdicts(df) == plain_rows(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_lone_empty_and_long(spark):
    one = spark.createDataFrame([(5, "just one")], "doc_id long, text string")
    assert verdicts(one)[0][0:2] == (5, 8) and verdicts(one)[0][6] == 1.0
    nothing = spark.createDataFrame([(5, None)], "doc_id long, text string")
    assert verdicts(nothing) == [(5, 0, hashlib.sha256(b"").hexdigest(), "2::", "2::", 1.0, 1.0)]
    assert verdicts(one.limit(0)) == []
    rng = random.Random(4)
    long = "".join(rng.choices("abcdefg ", k=1 << 18)) * 12
    found = verdicts(spark.createDataFrame([(1, long), (2, "short")], "doc_id long, text string"))
    assert found[0][1] == len(long) and found[0][3] == fingerprint(long.encode())


def test_null_and_repeated_ids_and_clashing_columns(spark):
    base = [(1, "one text of some length"), (2, "another text, longer than that"), (2, "a third text"), (None, "no id"), (None, None)]
    rows = base + [(2, "a third text")] * 30 + [(None, "no id")] * 2
    df = spark.createDataFrame([(*r, 0, "x", "y") for r in rows], "doc_id long, text string, id int, same string, again string")
    found = fingerprints(df.repartition(3)).collect()
    assert len(found) == len(rows)
    by_row = {}
    for r in found:
        by_row.setdefault((r.doc_id if "doc_id" in r else r.id, r.n_chars), set()).add(tuple(r)[1:])
    assert {k: len(v) for k, v in by_row.items()} == {(i, len(t or "")): 1 for i, t in base}
    # Copies follow nothing of their own kind: each takes the front of the next different document.
    order = sorted(base, key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert {r[0] for r in order[:2]} == {2}
    hashes = dict(df.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).distinct().collect())
    order.sort(key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]]))
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        changed = fp.edited(text or "", following or "")
        assert next(iter(by_row[i, len(text or "")]))[1] == hashlib.sha256(changed.encode()).hexdigest()
