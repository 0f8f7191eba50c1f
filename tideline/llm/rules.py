"""Quality rules: base counts, and the divergence of a document from its language."""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import fresh, raw_bytes, save, slices, text_of

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
CLASSES = ("lower", "upper", "letter", "mark", "number", "prose", "symbol", "space", "control")
PROSE = set(".,;:'\"?!()-")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of ``window`` words that the text has twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for i in range(window):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + (hashes[i : i + n] ^ (hashes[i : i + n] >> np.uint64(29)))
    order = np.argsort(rolled, kind="stable")
    same = rolled[order][1:] == rolled[order][:-1]
    if not same.any():
        return 0
    maybe = np.zeros(n, bool)
    maybe[order[1:][same]] = maybe[order[:-1][same]] = True
    # Equal hashes are confirmed on the words themselves.
    starts = np.flatnonzero(maybe).tolist()
    seen = Counter(tuple(words[s : s + window]) for s in starts)
    covered = np.zeros(len(words) + 1, np.int64)
    for s in starts:
        if seen[tuple(words[s : s + window])] > 1:
            covered[s] += 1
            covered[s + window] -= 1
    return int((np.cumsum(covered)[:-1] > 0).sum())


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    solid = text.translate(None, WHITE)
    chars = len(solid) if solid.isascii() else len(solid.decode())
    lines = [line for line in text.split(b"\n") if line.strip(WHITE)]
    return (
        len(words),
        chars,
        len(solid) - len(solid.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """The class of every code point."""
    table = np.empty(0x110000, np.uint8)
    by = {"Ll": 0, "Lu": 1, "L": 2, "M": 3, "N": 4, "P": 6, "S": 6, "Z": 7, "C": 8}
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))
        table[code] = by[kind] if kind in by else by[kind[0]]
    for char in PROSE:
        table[ord(char)] = 5
    for white in WHITE:
        table[white] = 7
    return table


def class_counts(text: bytes) -> np.ndarray:
    """How many characters of each of ``CLASSES`` the text has."""
    codes = np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)
    return np.bincount(_class_table()[codes], minlength=len(CLASSES))


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """The square root of the Jensen-Shannon divergence to base 2: 0 for equal shares, at most 1."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return math.sqrt(max(0.0, min(1.0, parts / 2)))


@dataclass
class Reference:
    """A language's character classes and common words; the last of ``shares`` is all other words."""

    classes: np.ndarray
    words: dict[bytes, int]
    shares: np.ndarray

    def distances(self, text: bytes, words: list[bytes]) -> tuple[float, float]:
        found = [self.words[w] for w in map(bytes.lower, words) if w in self.words]
        counts = np.bincount(found, minlength=len(self.shares))
        counts[-1] = len(words) - len(found)
        return js_distance(class_counts(text), self.classes), js_distance(counts, self.shares)


@dataclass(frozen=True)
class Limits:
    """When a document is judged, and what is too far.

    ``min_words``, ``min_repeat``: the base rule (a share of words in percent). A document is held
    against its language only with ``guard_chars`` characters and ``guard_words`` words or more:
    shorter histograms say little. The distance that is allowed grows as the document shrinks, by
    a slack over the square root of its words, as the distance of a random sample of the language
    does.
    """

    min_words: int = 20
    min_repeat: int = 30
    guard_chars: int = 80
    guard_words: int = 20
    class_distance: float = 0.24
    class_slack: float = 0.6
    word_distance: float = 0.22
    word_slack: float = 1.7

    def too_far(self, n_words: int, by_class: float, by_word: float) -> bool:
        wide = 1 / math.sqrt(n_words)
        return (
            by_class > self.class_distance + self.class_slack * wide
            or by_word > self.word_distance + self.word_slack * wide
        )


def language_references(
    docs: DataFrame, text: str, lang: str, common: float = 0.002, least: float = 0.001
) -> dict[str | None, Reference]:
    """References from the whole texts of all documents.

    A word (A-Z lower-cased) is common if it holds ``common`` of its language's words, so a language
    has at most 1 / ``common`` of them. A language has a reference if it holds ``least`` of all
    words, so there are at most 1 / ``least``; the key None has that of all languages together. What
    comes to the driver is bounded by these two.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}

        def rows() -> pa.RecordBatch:
            found = [(lang, word, n) for lang, c in words.items() for word, n in c.items()]
            found += [(lang, b" %d" % i, int(n)) for lang, c in classes.items() for i, n in enumerate(c)]
            columns = list(zip(*found)) or [(), (), ()]
            types = (pa.string(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "word", "n"]
            )

        for batch in slices(batches):
            for lang, value in zip(batch.column(0).to_pylist(), raw_bytes(batch.column(1))):
                words.setdefault(lang, Counter()).update(value.lower().split())
                classes[lang] = classes.get(lang, 0) + class_counts(value)
            if sum(map(len, words.values())) > 300_000:
                yield rows()
                words, classes = {}, {}
        yield rows()

    texts = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")).alias("lang"), text_of(text))
    counted = texts.mapInArrow(count, "lang string, word binary, n bigint")
    counts = save(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "rule-words")
    is_class = F.substr("word", F.lit(1), F.lit(1)) == F.lit(b" ")
    totals = counts.where(~is_class).groupBy("lang").agg(F.sum("n").alias("total"))
    everything = totals.agg(F.sum("total")).first()[0] or 0
    large = totals.where(F.col("total") >= least * everything)
    pooled = counts.groupBy("word").agg(F.sum("n").alias("n")).withColumns(
        {"lang": F.lit(None).cast("string"), "total": F.lit(everything)}
    )
    wanted = counts.join(large, "lang").select("lang", "word", "n", "total").unionByName(pooled)
    wanted = wanted.where(is_class | (F.col("n") >= common * F.col("total"))).orderBy("lang", F.desc("n"), "word")
    found: dict[str | None, list] = {}
    for row in wanted.collect():
        found.setdefault(row.lang, []).append((bytes(row.word), row.n, row.total))
    references = {}
    for lang, rows in found.items():
        classes = np.zeros(len(CLASSES))
        for word, n, _ in rows:
            if word.startswith(b" "):
                classes[int(word)] = n
        kept = [(word, n) for word, n, _ in rows if not word.startswith(b" ")]
        if not kept and not classes.sum():
            continue
        rest = max(rows[0][2] - sum(n for _, n in kept), 1)
        shares = np.array([n for _, n in kept] + [rest], float)
        references[lang] = Reference(np.maximum(classes, 1e-9), {w: i for i, (w, _) in enumerate(kept)}, shares)
    return references


def quality_rules(
    docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits()
) -> DataFrame:
    """``docs`` without the text, with base counts, distances and verdict of each whole text.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance,
    word_distance and kept. The distances are Jensen-Shannon distances of the document's character
    classes and common words to its language's, null where a guard makes the document too short. A
    document is kept if the base rule passes and no distance is above its limit.

    Null and empty texts have no words and fail the base rule. A null language counts as the empty
    one; languages too small for a reference are held against all languages together. Repeated rows
    are judged one by one (and count for the references each time). An empty table gives an empty
    table. The new columns replace those of the same names.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(language_references(docs, text, lang))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    new = [*counts, "base_failed", "class_distance", "word_distance", "kept"]
    rest = [c for c in docs.columns if c != text and c.lower() not in new]
    known, carried = fresh(docs, "lang_to_judge"), fresh(docs, "text_to_judge")
    rows = docs.select(
        *[F.col(f"`{c}`") for c in rest],
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")).alias(known),
        text_of(text).alias(carried),
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        references = shared.value
        for batch in slices(batches):
            out = []
            for lang, value in zip(batch.column(batch.num_columns - 2).to_pylist(), raw_bytes(batch.column(batch.num_columns - 1))):
                words = value.split()
                base = base_counts(value, words)
                failed = base[0] < limits.min_words or 100 * base[4] > limits.min_repeat * base[0]
                reference = references.get(lang) or references.get(None)
                by_class = by_word = None
                if reference and base[0] >= limits.guard_words and base[1] >= limits.guard_chars:
                    by_class, by_word = reference.distances(value, words)
                far = by_class is not None and limits.too_far(base[0], by_class, by_word)
                out.append((*base, failed, by_class, by_word, not failed and not far))
            types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            made = [pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * len(types), types)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *made], names=[*rest, *new])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-2])
    kinds = ["bigint"] * 5 + ["boolean", "double", "double", "boolean"]
    return rows.mapInArrow(judge, kept + ", ".join(f"{c} {t}" for c, t in zip(new, kinds)))
