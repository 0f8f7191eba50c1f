"""Document fingerprints: context-triggered piecewise hashing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import raw_bytes, save, slices, text_of

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
# Bytes that the rolling hash looks back on, most chunks of a signature, and bytes of a text that
# are hashed in one go.
WINDOW, CHUNKS, PIECE = 7, 64, 1 << 20
# Chunks are of 2**level bytes on average; beyond the last level a text is one chunk.
FIRST_LEVEL, LAST_LEVEL = 2, 31
# Chunks in a row that two signatures must share to be alike at all.
SHARED = 4


def _rolled(piece: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte from the ``WINDOW``th on: a polynomial of the bytes in the
    window, with its bits mixed."""
    n = len(piece) - WINDOW + 1
    value = np.zeros(n, np.uint32)
    for i in range(WINDOW):
        value = value * np.uint32(0x01000193) + piece[i : i + n]
    value = (value ^ (value >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return value ^ (value >> np.uint32(13))


def _triggers(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ends, hashes) of the places that end a chunk of the first level."""
    mask = np.uint32((1 << FIRST_LEVEL) - 1)
    padded = np.frombuffer(b"\0" * (WINDOW - 1) + text, np.uint8).astype(np.uint32)
    ends, hashes = [], []
    for at in range(0, len(text), PIECE):
        value = _rolled(padded[at : at + PIECE + WINDOW - 1])
        here = np.flatnonzero((value & mask) == 0)
        ends.append(here + at + 1)
        hashes.append(value[here])
    return np.concatenate(ends), np.concatenate(hashes)


def _signature(text: bytes, ends: np.ndarray) -> str:
    """A character for each chunk."""
    cuts = [0, *ends.tolist()]
    if cuts[-1] < len(text):
        cuts.append(len(text))
    return "".join(ALPHABET[xxhash.xxh3_64_intdigest(text[s:e]) & 63] for s, e in zip(cuts, cuts[1:]))


def fingerprint(text: bytes) -> str:
    """``level:signature:signature of the next level`` of a text.

    A chunk ends where the rolling hash has ``level`` low bits of zero, so ends of one level are ends
    of the levels before, and an edit moves none beyond its window. The level is the lowest
    that leaves at most ``CHUNKS`` chunks. Equal texts have equal fingerprints; the empty text's is ``2::``.
    """
    if not text:
        return f"{FIRST_LEVEL}::"
    ends, hashes = _triggers(text)

    def of_level(level: int) -> np.ndarray:
        return ends[(hashes & np.uint32((1 << level) - 1)) == 0] if level <= LAST_LEVEL else ends[:0]

    level, here = FIRST_LEVEL, ends
    while len(here) + (len(here) == 0 or here[-1] < len(text)) > CHUNKS:
        level += 1
        here = of_level(level)
    return f"{level}:{_signature(text, here)}:{_signature(text, of_level(level + 1))}"


def _squeezed(signature: str) -> str:
    """Runs of a character cut to three: they say little about a text."""
    return "".join(c for i, c in enumerate(signature) if signature[max(0, i - 3) : i] != c * 3)


def edit_distances(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """The edit distances of pairs of strings of 1 to 64 bytes, all pairs at once: a column of a
    pair's table is held as differences, in the bits of two words."""
    m, n = np.array(list(map(len, left))), np.array(list(map(len, right)))
    a = np.frombuffer(b"".join(s.ljust(64, b"\0") for s in left), np.uint8).reshape(-1, 64)
    b = np.frombuffer(b"".join(s.ljust(64, b"\1") for s in right), np.uint8).reshape(-1, 64)
    up, down, distance = np.full(len(m), ~np.uint64(0)), np.zeros(len(m), np.uint64), m.copy()
    last, one = (m - 1).astype(np.uint64), np.uint64(1)
    for j in range(n.max(initial=0)):
        equal = np.packbits(a == b[:, j : j + 1], axis=1, bitorder="little").view("<u8")[:, 0]
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        more, less = down | ~(horizontal | up), up & horizontal
        step = ((more >> last) & one).astype(np.int64) - ((less >> last) & one).astype(np.int64)
        distance += np.where(j < n, step, 0)
        more, less = (more << one) | one, less << one
        up, down = less | ~(vertical | more), more & vertical
    return distance


def _comparable(left: str, right: str) -> list[tuple[str, str]]:
    """The signatures of two fingerprints that are of the same level."""
    (k, *first), (j, *second) = left.split(":"), right.split(":")
    by_level = {int(k) + i: s for i, s in enumerate(first)}
    return [(by_level[int(j) + i], s) for i, s in enumerate(second) if int(j) + i in by_level]


def likenesses(pairs: list[tuple[str, str]]) -> np.ndarray:
    """How alike the fingerprints of each pair are, from 0 to 1.

    Signatures of the same level are compared, the better of two counts: one minus the edit distance over the
    longer length, with longer runs of a character cut to three. Signatures that do not share ``SHARED``
    chunks in a row (the whole shorter one, if it has fewer) are not alike, and neither are
    fingerprints more than one level apart. Equal fingerprints have 1, an empty text and another 0.
    """
    best = np.array([float(a == b) for a, b in pairs])
    asked, left, right = [], [], []
    for i, (a, b) in enumerate(pairs):
        if best[i]:
            continue
        for s, t in _comparable(a, b):
            s, t = _squeezed(s), _squeezed(t)
            least = min(SHARED, len(s), len(t))
            if least and {s[k : k + least] for k in range(len(s) - least + 1)} & {
                t[k : k + least] for k in range(len(t) - least + 1)
            }:
                asked.append(i)
                left.append(s.encode())
                right.append(t.encode())
    if asked:
        longer = np.maximum(list(map(len, left)), list(map(len, right)))
        np.maximum.at(best, asked, 1 - edit_distances(left, right) / longer)
    return best


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the front of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_VERDICT = [
    ("n_chars", pa.int64(), "bigint"),
    ("edited_sha256", pa.string(), "string"),
    ("fingerprint", pa.string(), "string"),
    ("edited_fingerprint", pa.string(), "string"),
    ("near_edited", pa.float64(), "double"),
    ("near_next", pa.float64(), "double"),
]


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogateescape")


def _text(raw: bytes) -> str:
    return raw.decode("utf-8", "surrogateescape")


def _verdicts(steps: list[tuple[str, str, str, str]]) -> list[list]:
    """The columns of ``_VERDICT`` for (text, its fingerprint, following text, its fingerprint) rows."""
    changed = [_bytes(edited(text, following)) for text, _, following, _ in steps]
    marks = [fingerprint(c) for c in changed]
    near = likenesses([(own, mark) for (_, own, _, _), mark in zip(steps, marks)])
    following = likenesses([(own, other) for _, own, _, other in steps])
    return [
        [len(s[0]) for s in steps],
        [hashlib.sha256(c).hexdigest() for c in changed],
        [s[1] for s in steps],
        marks,
        near.tolist(),
        following.tolist(),
    ]


_NAMES = ["id", "same", *(name for name, _, _ in _VERDICT)]


def _schema(id_type: str) -> str:
    return ", ".join([f"id {id_type}", "same bigint", *(f"{name} {sql}" for name, _, sql in _VERDICT)])


def _along(rows: DataFrame, id_type: str) -> DataFrame:
    """Verdicts of all rows but the last of each partition, and the two ends of each partition: its
    first and its last row with their texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, kind = TaskContext.get().partitionId(), None, None

        def made(ids, verdicts, end=None, texts=None) -> pa.RecordBatch:
            n, (first, same) = len(ids), list(zip(*ids)) or [(), ()]
            columns = [pa.array(first, kind), pa.array(same, pa.int64())]
            columns += [pa.array(v, t) for v, (_, t, _) in zip(verdicts, _VERDICT)]
            columns += [pa.array([part] * n, pa.int32()), pa.array([end] * n, pa.string())]
            columns.append(pa.array(texts or [None] * n, pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=[*_NAMES, "part", "end", "text"])

        def loose(row, end: str) -> pa.RecordBatch:
            return made([row[0]], [[None], [None], [row[2]], [None], [None], [None]], end, [_bytes(row[1])])

        for batch in slices(batches, 256):
            ids, steps, kind = [], [], batch.schema.field(0).type
            columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw_bytes(batch.column(2))
            for id_, same, raw in zip(*columns):
                row = ((id_, same), _text(raw), fingerprint(raw))
                if before is None:
                    yield loose(row, "first")
                else:
                    ids.append(before[0])
                    steps.append((*before[1:], *row[1:]))
                before = row
            yield made(ids, _verdicts(steps))
        if before is not None:
            yield loose(before, "last")

    return rows.mapInArrow(work, f"{_schema(id_type)}, part int, end string, text binary")


def _across(ends: DataFrame, id_type: str) -> DataFrame:
    """Verdicts of the last rows of partitions: what follows is the first row of the next partition
    that has rows, after the last that of the first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            steps = [(_text(t), own, _text(u), other) for t, own, u, other in zip(*(c.to_pylist() for c in batch.columns[2:]))]
            made = [pa.array(v, t) for v, (_, t, _) in zip(_verdicts(steps), _VERDICT)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made], names=_NAMES)

    firsts = ends.where("end = 'first'")
    # A row per partition: no more than a shuffle has partitions.
    parts = [r.part for r in firsts.select("part").orderBy("part").collect()]
    after = F.create_map(*[F.lit(p) for pair in zip(parts, parts[1:] + parts[:1]) for p in pair])
    lasts = ends.where("end = 'last'").select("id", "same", "text", "fingerprint", after[F.col("part")].alias("next"))
    follow = firsts.select(
        F.col("part").alias("next"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint")
    )
    met = lasts.join(follow, "next")
    return met.select("id", "same", "text", "fingerprint", "next_text", "next_fingerprint").mapInArrow(work, _schema(id_type))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    A row is compared with an edited version of itself, whose last third is the front of the next
    document's text, and with the next document. The order is by descending id; after the last comes
    the first, so a lone row follows itself. Texts are shuffled once, by ranges of ids; a task goes
    along its range and needs two rows at a time. What lies across the borders of ranges, two rows of
    each, is compared afterwards.

    Null texts count as empty. Rows without an id come last; among rows that repeat an id, or have
    none, the order is by a hash of the text. Rows that repeat an id and its text are one document there
    and share its verdict: such a group is combined before texts are shuffled. Very long texts are
    hashed whole, a piece at a time. An empty table gives an empty table. Other columns are not read.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), text_of(text).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("same"), "text")
    again = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = save(again.select(F.col("id").alias("again")), "fingerprints-again")
    single, repeated, repeats = rows, None, F.col("id").eqNullSafe(F.col("again"))
    if not again.isEmpty():
        repeated = rows.join(again, repeats, "left_semi")
        single = rows.join(again, repeats, "left_anti").unionByName(repeated.distinct())
    order = [F.col("id").desc_nulls_last(), F.col("same")]
    ranged = single.repartitionByRange(*order).sortWithinPartitions(*order)
    done = save(_along(ranged, id_type), "fingerprints-ranges")
    ends = done.where("end is not null")
    found = done.where("end is null").select(*_NAMES)
    if not ends.isEmpty():
        found = found.unionByName(_across(ends, id_type))
    if repeated is None:
        return found.drop("same")
    found = save(found, "fingerprints-found")
    verdicts = found.join(again, repeats, "left_semi").withColumnsRenamed({"id": "id_", "same": "same_"})
    every = save(repeated.select("id", "same"), "fingerprints-repeated")
    met = every.join(verdicts, F.col("id").eqNullSafe(F.col("id_")) & (F.col("same") == F.col("same_")))
    return found.join(again, repeats, "left_anti").drop("same").unionByName(met.drop("same", "id_", "same_"))
