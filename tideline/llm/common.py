"""What several of the operators share."""

from __future__ import annotations

import re
import tempfile
import unicodedata
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import scratch_path

# Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for workers that lack it."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    _shipped.add(application)
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="tideline-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))


def save(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back.

    Cuts the lineage at a point that outlives any executor, and leaves later joins with plain
    scans below their exchanges, so that AQE may split a hot partition.
    """
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in small slices: what Python makes of one at a time stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def raw_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """A tokenizer file, loaded once per worker."""
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@dataclass(frozen=True)
class Classes:
    """What a tokenizer's pre-tokenizer takes for letters, numbers and white space, as bodies of
    character classes, and all characters of which that is known."""

    letters: str
    numbers: str
    spaces: str
    known: str


# Characters that are asked about: the first two planes, where all scripts in use and the symbols are.
_ASKED = range(0x20000)


def _ranges(characters: list[str]) -> str:
    """The body of a character class."""
    points, parts = sorted(map(ord, characters)), []
    for point in points:
        if parts and parts[-1][1] == point - 1:
            parts[-1][1] = point
        else:
            parts.append([point, point])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in parts)


@lru_cache(maxsize=4)
def classes(path: str) -> Classes:
    """The classes of the tokenizer file itself, found by how it splits each character between
    others. Characters that nobody has assigned yet are left out, as libraries may disagree on them;
    so are those that its normalizer changes in another way than ``str.lower``.
    """
    loaded = tokenizer(path)
    asked = [c for c in map(chr, _ASKED) if unicodedata.category(c) not in ("Cn", "Cs", "Co")]
    if loaded.normalizer is not None:
        # Line by line: each is normalised by itself. A capital sigma's small letter depends on what follows.
        white = {c for c in asked if c.isspace()}
        asked = [c for c in asked if c in white or (c != "\u03a3" and loaded.normalizer.normalize_str(c) == c.lower())]

    def pieces(left: str, right: str, some: list[str]) -> list[int]:
        """Into how many pieces each character falls between two others."""
        found = []
        for at in range(0, len(some), 4096):
            part = some[at : at + 4096]
            text = "\n".join(f"{left}{c}{right}" for c in part)
            starts = [s for _, (s, _) in loaded.pre_tokenizer.pre_tokenize_str(text)]
            width = len(left) + len(right) + 2
            counts = [0] * len(part)
            for s in starts:
                if s % width != width - 1:  # not the line's end
                    counts[s // width] += 1
            found += counts
        return found

    inside = dict(zip(asked, zip(pieces("a", "a", asked), pieces("!", "!", asked), pieces("1", "1", asked))))
    letters = [c for c, (a, _, _) in inside.items() if a == 1]
    symbols = {c for c, (_, s, _) in inside.items() if s == 1}
    rest = [c for c in asked if c not in symbols and inside[c][0] > 1]
    # White space is a piece of its own, or none; so are numbers where they are split one by one.
    numbers = [c for c in rest if inside[c][2] == 1] or [c for c in rest if inside[c][2] == 3]
    spaces = [c for c in rest if c not in set(numbers)]
    return Classes(*map(_ranges, (letters, numbers, spaces, asked)))


# The pre-token patterns of the two tokenizer files, over classes.
def _byte_bpe(letters: str, numbers: str, spaces: str) -> re.Pattern:
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
        rf"|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
    )


def _word_bpe(letters: str, numbers: str, spaces: str) -> re.Pattern:
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+")


# The same for letters, white space and other characters below U+0100 on which Python's and the tokenizers'
# classes are the same: most texts of western languages need no more, and small classes are quick.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_SPACE = " \t-\r"
_BEYOND = re.compile("[^\x00-\x1b\x20-\x7eÀ-ÿ]")
_PATTERNS = {False: _byte_bpe(_LETTER, "0-9", _SPACE), True: _word_bpe(_LETTER, "0-9", _SPACE)}


@lru_cache(maxsize=8)
def _patterns(found: Classes, by_word: bool) -> tuple[re.Pattern, re.Pattern]:
    made = (_word_bpe if by_word else _byte_bpe)(found.letters, found.numbers, found.spaces)
    return re.compile(f"[^{found.known}]"), made


def split_text(text: str, found: Classes, by_word: bool = False) -> list[str] | None:
    """The pre-tokens of a text; lower-cased, for a vocabulary ``by_word``. None if only the tokenizer itself
    is sure of them: where a character is not among its known classes, or letters and marks would be composed."""
    if not _BEYOND.search(text):
        return _PATTERNS[by_word].findall(text.lower() if by_word else text)
    unknown, pattern = _patterns(found, by_word)
    if unknown.search(text) or (by_word and not unicodedata.is_normalized("NFC", text)):
        return None
    return pattern.findall(text.lower() if by_word else text)


@lru_cache(maxsize=1)
def _byte_characters() -> dict[int, int]:
    """The character that byte-level vocabularies write for each byte: itself where it prints, else
    the next unused one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in prints]
    return {b: 256 + i for i, b in enumerate(others)}


def piece_tokens(piece: str, path: str) -> list:
    """The tokens of one pre-token, from the tokenizer's model alone: what comes before the model
    leaves a pre-token as it is, and costs several times as much."""
    if not (piece.isascii() and piece.isalnum()):
        piece = piece.encode().decode("latin-1").translate(_byte_characters())
    return tokenizer(path).model.tokenize(piece)


class PieceCache(dict):
    """What a tokenizer makes of a pre-token; misses are encoded and kept.

    When it holds ``limit`` pre-tokens besides the ``first`` ones, they become the older
    generation, from which those still in use are taken over, and the one before is dropped. So a
    worker's memory is bounded whatever the corpus holds. That costs time and never changes a result.
    """

    def __init__(self, encode, limit: int, first: dict | None = None):
        super().__init__(first or {})
        self._encode, self._first, self._older = encode, first or {}, {}
        self._limit = limit + len(self._first)

    def __missing__(self, piece: str):
        if len(self) >= self._limit:
            self._older = dict(self)
            self.clear()
            self.update(self._first)
        made = self._older.get(piece)
        if made is None:
            made = self._encode(piece)
        self[piece] = made
        return made


_kept: dict[tuple, PieceCache] = {}


def kept(key: tuple, make: Callable[[], PieceCache]) -> PieceCache:
    """The cache of one step in this worker. Workers are used again by the steps that follow, so a worker
    has one cache at a time: that of another step goes when this one's is made."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def release() -> None:
    """Drop the caches and tokenizers that earlier steps left in this worker, for tasks that need none."""
    _kept.clear()
    tokenizer.cache_clear()
