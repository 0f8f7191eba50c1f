"""Token counts by a two-tier lookup in the map tasks."""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyarrow import compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import (
    Classes,
    PieceCache,
    classes,
    fresh,
    kept,
    piece_tokens,
    slices,
    split_text,
    text_of,
    tokenizer,
)

# Pre-tokens in the broadcast table: at some 12 bytes each, about half a MB packed.
FREQUENT = 32_768
# Pre-tokens that a worker keeps beside it.
CACHED = 300_000
# Counters that one merging task takes.
FAN_IN = 16


@lru_cache(maxsize=4)
def _specials(path: str) -> tuple[str, ...]:
    return tuple(t.content for t in tokenizer(path).get_added_tokens_decoder().values())


def pre_tokens(text: str, specials: tuple[str, ...], found: Classes) -> list[str] | None:
    """The byte-level pre-tokens of a text, or None if only the tokenizer itself is sure of them."""
    return None if any(s in text for s in specials) else split_text(text, found)


def _pack(counts: Counter, size: int) -> bytes:
    return zlib.compress(pickle.dumps(counts.most_common(size)), 1)


def _unpack(blob: bytes) -> Counter:
    return Counter(dict(pickle.loads(zlib.decompress(blob))))


def frequent_pre_tokens(docs: DataFrame, text: str, path: str, size: int = FREQUENT) -> list[str]:
    """The most frequent pre-tokens of all texts, nearly: they only decide what is quick to look up.

    Each task counts its whole texts in a counter it prunes to ``size`` entries whenever it holds
    eight times as many, and sends one packed counter. These are merged as a tree, ``FAN_IN`` at a
    time; the driver gets one. No pre-token is shuffled.
    """

    found = classes(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        specials, counts = _specials(path), Counter()
        for batch in slices(batches):
            for value in batch.column(0).to_pylist():
                counts.update(pre_tokens(value, specials, found) or ())
                if len(counts) > 8 * size:
                    counts = Counter(dict(counts.most_common(size)))
        yield pa.RecordBatch.from_pydict({"counts": [_pack(counts, size)]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                counts.update(_unpack(blob))
        yield pa.RecordBatch.from_pydict({"counts": [_pack(counts, size)]})

    texts = docs.select(text_of(text).alias("text"))
    packed, parts = texts.mapInArrow(count, "counts binary"), texts.rdd.getNumPartitions()
    while parts > 1:
        parts = -(-parts // FAN_IN)
        packed = packed.repartition(parts).mapInArrow(merge, "counts binary")
    counts = Counter()
    for row in packed.collect():
        counts.update(_unpack(bytes(row.counts)))
    return [piece for piece, _ in counts.most_common(size)]


def _lengths(pieces: list[str], path: str) -> bytes:
    """The table that is broadcast: the pieces in one string and their token counts."""
    counts = [len(e.ids) for e in tokenizer(path).encode_batch(pieces, add_special_tokens=False)]
    return zlib.compress(pickle.dumps(("\x1f".join(pieces), counts)), 6)


def _table(packed: bytes, path: str, limit: int) -> PieceCache:
    """A worker's lookup: the broadcast table, and behind it what the worker has encoded itself."""

    def make() -> PieceCache:
        joined, counts = pickle.loads(zlib.decompress(packed))
        first = dict(zip(joined.split("\x1f"), counts)) if counts else {}
        return PieceCache(lambda piece: len(piece_tokens(piece, path)), limit, first)

    return kept(("counts", packed, path, limit), make)


def count_tokens(
    docs: DataFrame,
    path: str,
    text: str = "text",
    limit: int = 1024,
    frequent: int = FREQUENT,
    cached: int = CACHED,
) -> DataFrame:
    """``docs`` without the text, with n_bytes, n_tokens and over_limit of each whole text.

    A count is what the byte-level BPE file at ``path`` gives for the text without added tokens.
    Pre-tokens are counted one by one: first in a broadcast table of the ``frequent`` ones, then in
    the worker's own cache of up to ``cached``, then by the tokenizer, whatever script a text is in. Only
    texts that hold a special token's string, or a character that is not assigned, go to the tokenizer whole.
    The second pass is one map over the rows: nothing is shuffled.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows are counted one by one; an empty
    table gives an empty table. The three columns replace those of the same names.
    """
    pieces = frequent_pre_tokens(docs, text, path, frequent)
    table = docs.sparkSession.sparkContext.broadcast(_lengths(pieces, path))
    known = classes(path)
    new = ("n_bytes", "n_tokens", "over_limit")
    rest = [c for c in docs.columns if c != text and c.lower() not in new]
    carried = fresh(docs, "text_to_count")
    rows = docs.select(*[F.col(f"`{c}`") for c in rest], text_of(text).alias(carried))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, specials, whole = _table(table.value, path, cached), _specials(path), tokenizer(path)
        for batch in slices(batches):
            counts = []
            for value in batch.column(batch.num_columns - 1).to_pylist():
                pieces = pre_tokens(value, specials, known)
                if pieces is None:
                    counts.append(len(whole.encode(value, add_special_tokens=False).ids))
                else:
                    counts.append(sum(map(lookup.__getitem__, pieces)))
            size = compute.binary_length(batch.column(batch.num_columns - 1))
            n_tokens = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], size.cast(pa.int64()), n_tokens], names=[*rest, *new[:2]]
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    schema = f"{kept}{', ' if kept else ''}n_bytes bigint, n_tokens bigint"
    return rows.mapInArrow(count, schema).withColumn(new[2], F.col(new[1]) > limit)
