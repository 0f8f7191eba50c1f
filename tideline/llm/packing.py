"""Packing along a space-filling curve."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import (
    Classes,
    PieceCache,
    classes,
    kept,
    piece_tokens,
    release,
    save,
    slices,
    split_text,
    text_of,
    tokenizer,
)

SEQUENCE = 2048
# Pre-tokens that a worker keeps the ids of.
CACHED = 300_000
# Hash buckets of a document's vector, curve dimensions and bits for each.
BUCKETS, DIMENSIONS, BITS = 256, 4, 12
PART_BITS = 40


def id_kind(path: str) -> str:
    """How ids are written between the steps: little-endian, as few bytes as the vocabulary needs."""
    return "<u2" if tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4"


def _piece_ids(path: str, limit: int) -> PieceCache:
    def make() -> PieceCache:
        code = "H" if id_kind(path) == "<u2" else "I"
        return PieceCache(lambda piece: array(code, [t.id for t in piece_tokens(piece, path)]).tobytes(), limit)

    return kept(("ids", path, limit), make)


@lru_cache(maxsize=2)
def _specials(path: str) -> tuple[str, ...]:
    return tuple(t.content.lower() for t in tokenizer(path).get_added_tokens_decoder().values())


def text_ids(text: str, path: str, found: Classes, limit: int = CACHED) -> bytes:
    """The text's ids as the library gives them, written as ``id_kind`` says.

    Lower-cased pre-tokens are looked up in the worker's cache; a text with a special token's
    string, or with characters that ``split_text`` is not sure of, goes to the library whole.
    """
    lower = text.lower()
    special = any(s in lower for s in _specials(path))
    pieces = None if special else split_text(text, found, by_word=True)
    if pieces is None:
        return np.array(tokenizer(path).encode(text, add_special_tokens=False).ids, id_kind(path)).tobytes()
    return b"".join(map(_piece_ids(path, limit).__getitem__, pieces))


@lru_cache(maxsize=2)
def _projection(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((BUCKETS, DIMENSIONS))


def projected(ids: np.ndarray, seed: int) -> np.ndarray:
    """Hash the ids into a vector of square roots of shares and project it to the curve's dimensions."""
    buckets = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)
    vector = np.sqrt(np.bincount(buckets.astype(np.int64), minlength=BUCKETS) / max(1, len(ids)))
    return vector @ _projection(seed)


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions of integer points (n x d, each below 2**bits) along a Hilbert curve, d * bits <= 63.

    Works on the transposed form of the index (one word per dimension): undo the excess rotations
    from the top bit down, Gray-encode across the dimensions, interleave the bits.
    """
    x = points.astype(np.int64).T.copy()
    d = len(x)
    for level in range(bits - 1, 0, -1):
        top, low = 1 << level, (1 << level) - 1
        for i in range(d):
            inverted = (x[i] & top) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inverted, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[d - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def curve_key(points: np.ndarray) -> np.ndarray:
    """Hilbert keys of projected vectors. These have length 1 before the projection, so a
    coordinate is hardly ever outside [-4, 4]; what is, belongs to the outermost cell."""
    cells = ((np.clip(points, -4, 4) + 4) / 8 * (1 << BITS)).astype(np.int64)
    return hilbert_key(np.minimum(cells, (1 << BITS) - 1))


def _tokenize(docs: DataFrame, path: str, end_id: int, seed: int) -> DataFrame:
    """(id, ids, curve, block): each document's ids as binary, in two bytes each where the vocabulary fits."""

    found = classes(path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = id_kind(path)
        end = np.array([end_id], kind).tobytes()
        for batch in slices(batches):
            ids = [text_ids(value, path, found) + end for value in batch.column(1).to_pylist()]
            points = np.stack([projected(np.frombuffer(i, kind), seed) for i in ids])
            made = [batch.column(0), pa.array(ids, pa.binary()), pa.array(curve_key(points)), batch.column(2)]
            yield pa.RecordBatch.from_arrays(made, names=["id", "ids", "curve", "block"])

    id_type = docs.schema["id"].dataType.simpleString()
    rows = docs.select("id", text_of("text").alias("text"), "block")
    return rows.mapInArrow(work, f"id {id_type}, ids binary, curve bigint, block bigint")


def fill(lengths: Iterator[tuple[int, int]], size: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Cut documents (number, length) in order into sequences.

    Gives (document, start, length, sequence, offset). Every sequence but the last ones has
    ``size`` tokens; what is left at the end is cut into sequences whose lengths are powers of two,
    so nothing is padded.
    """
    sequence, used, held = 0, 0, []
    for doc, length in lengths:
        start = 0
        while start < length:
            taken = min(length - start, size - used)
            held.append((doc, start, taken))
            start, used = start + taken, used + taken
            if used == size:
                offset = 0
                for d, s, n in held:
                    yield d, s, n, sequence, offset
                    offset += n
                sequence, used, held = sequence + 1, 0, []
    room, offset = (1 << used.bit_length()) >> 1, 0
    for d, s, n in held:
        while n:
            taken = min(n, room - offset)
            yield d, s, taken, sequence, offset
            s, n, offset, used = s + taken, n - taken, offset + taken, used - taken
            if offset == room:
                sequence, room, offset = sequence + 1, (1 << used.bit_length()) >> 1, 0


def pack(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text: str = "text",
    size: int = SEQUENCE,
    end_id: int = 1,
    parts: int | None = None,
    seed: int = 7,
    block: str | None = None,
) -> DataFrame:
    """Pack all texts, neighbours along a Hilbert curve together, into sequences of ``size`` tokens.

    One row per piece: id, start (ids of the document before it), length, ids (little-endian
    32-bit), doc_tokens (with the closing ``end_id``), sequence_id, offset.

    Texts are tokenized once and written as ids with a key of ``DIMENSIONS * BITS`` bits, made of
    the document's hashed vector. Rows are range-partitioned and sorted by (key, a hash of the row),
    which also cuts a key that a third of the rows share. Each partition is filled front to back
    and ends in sequences of power-of-two lengths, so partitions need nothing of each other.
    ``sequence_id`` is the partition number times 2**40 plus a count; ``parts`` (default: the
    session's shuffle partitions) should make a partition some hundred MB of ids. ``size`` must be a power
    of two. ``block`` names a column of blocks (``mixing.in_blocks``) that are packed one after the
    other, each along the curve.

    A null or empty text is the closing id alone. Null ids are packed like others; repeated rows are
    packed each. Ties on the key are ordered by a hash of id and ids; rows alike in both are
    interchangeable. An empty table has no pieces. Other columns are not read.
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    of = F.lit(0) if block is None else F.col(f"`{block}`")
    source = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"), of.cast("bigint").alias("block")
    )
    id_type = source.schema["id"].dataType.simpleString()
    rows = save(_tokenize(source, path, end_id, seed), "pack-ids")
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.withColumn("tie", F.xxhash64("id", "ids"))
    order = ["block", "curve", "tie"]
    ordered = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order, "id")

    kind = id_kind(path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        base = TaskContext.get().partitionId() << PART_BITS
        held: dict[int, tuple] = {}
        out: list[tuple] = []

        def documents() -> Iterator[tuple[int, int]]:
            number = 0
            for batch in slices(batches):
                for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    held[number] = (key, np.frombuffer(ids, kind).astype("<u4"))
                    yield number, len(held[number][1])
                    number += 1

        def batch_of() -> pa.RecordBatch:
            kinds = [pa_id, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        pa_id, done, first = None, 0, next(batches, None)
        if first is None:
            return
        pa_id = first.column(0).type

        def chained(rest=batches):
            yield first
            yield from rest

        batches = chained()
        for doc, start, length, sequence, offset in fill(documents(), size):
            while done < doc:  # pieces come in document order: earlier documents are finished
                held.pop(done)
                done += 1
            key, ids = held[doc]
            piece = ids[start : start + length].tobytes()
            out.append((key, start, length, piece, len(ids), base + sequence, offset))
            if len(out) >= 500:
                yield batch_of()
                out.clear()
        if out:
            yield batch_of()

    schema = (
        f"id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
    return ordered.select("id", "ids").mapInArrow(work, schema)
