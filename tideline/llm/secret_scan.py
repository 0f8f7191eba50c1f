"""Secret scans: fixed patterns, and a battery of randomness tests for everything else."""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import fresh, save, text_of


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
# kind, pattern, and for the first the least length of its group 2. A run of 16 after AKIA and one
# of 24 hexadecimal digits are the longer matches themselves: what is shorter would be dropped.
BASE = [
    ("assign", rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", "AKIA[A-Z0-9]{16,}"),
    ("hex", "[0-9a-f]{24,}"),
]
ASSIGN_LEAST = 6
RANDOM = "random"
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"
# No encoding has the characters of both: a run that does is split at either's.
MIXED = "[+/].*[_-]|[_-].*[+/]"
PARTS = ("[A-Za-z0-9+/]{20,}", "[A-Za-z0-9_-]{20,}")
# name, what its strings look like, its characters in order. The first that fits is inferred.
ENCODINGS = [
    ("base16", "^([0-9a-f]+|[0-9A-F]+)$", None),
    ("base32", "^[A-Z2-7]+$", string.ascii_uppercase + "234567"),
    ("base36", "^([0-9a-z]+|[0-9A-Z]+)$", None),
    ("base62", "^[0-9A-Za-z]+$", string.ascii_uppercase + string.ascii_lowercase + string.digits),
    ("base64", "^[0-9A-Za-z+/]+$", string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"),
    ("base64url", "^[0-9A-Za-z_-]+$", string.ascii_uppercase + string.ascii_lowercase + string.digits + "-_"),
]
_SIZES = {"base16": 16, "base32": 32, "base36": 36, "base62": 62, "base64": 64, "base64url": 64}
# Ordinary strings repeat characters like text does (index of coincidence), or as if they used half
# of the alphabet, whichever is less even.
TEXT_COINCIDENCE = 0.065
LENGTH_CLASSES = (20, 24, 32, 48, 64, 128)
P_STEP, P_BINS = 0.1, 120


def normal_tail(z: Column) -> Column:
    """P(Z > z), from a polynomial with a small relative error far into the tail."""
    a = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + a * 0.2316419)
    # The coefficients of the usual five-term approximation.
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(F.lit(1.0) - tail)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def randomness(token: Column) -> Column:
    """Struct (encoding, p_random, p_text) of an ASCII string.

    ``p_random``: the smallest of three tests' p-values, times three, if the characters were drawn
    evenly and independently from the inferred encoding: chi-squared uniformity over the alphabet,
    runs above and below its middle, lag-1 serial correlation of the positions in it.
    ``p_text``: how likely an ordinary string of this length (see ``TEXT_COINCIDENCE``) is as even.
    """
    n = F.length(token).cast("double")
    name = F.lit(None).cast("string")
    size = F.lit(64.0)
    order = F.lit(ENCODINGS[-1][2])
    lower = F.lit(string.digits + string.ascii_lowercase)
    for label, pattern, alphabet in reversed(ENCODINGS):
        fits = token.rlike(pattern)
        name = F.when(fits, F.lit(label)).otherwise(name)
        size = F.when(fits, F.lit(float(_SIZES[label]))).otherwise(size)
        order = F.when(fits, F.lit(alphabet) if alphabet else lower).otherwise(order)
    # Encodings of one letter case have their characters listed in lower case.
    plain = F.when(name.isin("base16", "base36"), F.lower(token)).otherwise(token)
    chars = F.split(plain, "")
    chars = F.filter(chars, lambda c: F.length(c) > 0)

    def measured(known: Column) -> Column:
        n, k, x = known["n"], known["k"], known["x"]
        squares = _total(
            F.transform(
                F.array_distinct(x),
                lambda c: F.pow(F.size(F.filter(x, lambda y: y == c)).cast("double"), F.lit(2.0)),
            )
        )
        chi = k / n * squares - n
        even = normal_tail((chi - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n)))
        high = F.transform(x, lambda v: (v >= k / 2).cast("double"))
        n1 = _total(high)
        n0 = n - n1
        pairs = F.sequence(F.lit(1), F.size(x) - 1)
        runs = 1 + _total(
            F.transform(pairs, lambda i: F.when(F.get(high, i) != F.get(high, i - 1), 1.0).otherwise(0.0))
        )
        expected = 2 * n0 * n1 / n + 1
        spread = F.sqrt((expected - 1) * (expected - 2) / (n - 1))
        runs_p = F.when(spread > 0, 2 * normal_tail(F.abs(runs - expected) / spread)).otherwise(F.lit(0.0))
        mean = _total(x) / n
        variance = _total(F.transform(x, lambda v: (v - mean) * (v - mean)))
        lagged = _total(F.transform(pairs, lambda i: (F.get(x, i) - mean) * (F.get(x, i - 1) - mean)))
        serial = F.when(
            variance > 0, 2 * normal_tail(F.abs(lagged / variance + 1 / n) * F.sqrt(n))
        ).otherwise(F.lit(0.0))
        alike = F.greatest(F.lit(TEXT_COINCIDENCE), 2 / k)
        excess = k * alike - 1
        text_chi = k * (1 - alike) + n * excess
        text = normal_tail((text_chi - chi) / F.sqrt(2 * (k - 1) + 4 * n * excess))
        return F.struct(
            known["encoding"].alias("encoding"),
            F.least(F.lit(1.0), 3 * F.least(even, runs_p, serial)).alias("p_random"),
            text.alias("p_text"),
        )

    known = F.struct(
        name.alias("encoding"),
        n.alias("n"),
        size.alias("k"),
        F.transform(chars, lambda c: (F.instr(order, c) - 1).cast("double")).alias("x"),
    )
    return F.transform(F.array(known), measured)[0]


# Array functions have no running sums: appending to an array copies it. In blocks of this many the copies
# stay in proportion to the array, near enough.
BLOCK = 256


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, wherever it then occurs."""
    return F.transform(F.array(value), use)[0]


def _blocks(values: Column) -> Column:
    last = F.floor((F.greatest(F.size(values), F.lit(1)) - 1) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * BLOCK + 1, BLOCK))


def _spans(text: Column, pattern: str) -> Column:
    """Array of (start, end, match) of the leftmost matches, in code points; the parts between
    matches and the matches themselves, which regular expressions give, add up to the positions."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("match"))
    kind = "array<struct<start:int,end:int,match:string>>"

    def step(at: Column, part: Column) -> Column:
        start = at["pos"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["match"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), part["match"].alias("match"))
        return F.struct(end.alias("pos"), F.when(part["match"].isNull(), at["spans"]).otherwise(F.array_append(at["spans"], span)).alias("spans"))

    def whole(located: Column) -> Column:
        """The blocks' spans, moved by the length of all blocks before."""
        none = F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("starts"))
        starts = F.aggregate(
            located,
            none,
            lambda at, b: F.struct((at["pos"] + b["pos"]).alias("pos"), F.array_append(at["starts"], at["pos"]).alias("starts")),
            lambda at: at["starts"],
        )
        return F.flatten(F.zip_with(located, starts, lambda b, by: F.transform(b["spans"], lambda s: _moved(s, by))))

    zero = F.struct(F.lit(0).alias("pos"), F.array().cast(kind).alias("spans"))
    spans = _bound(parts, lambda p: _bound(F.transform(_blocks(p), lambda b: F.aggregate(b, zero, step)), whole))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(kind))


def _moved(span: Column, by: Column) -> Column:
    start, end = span["start"] + by, span["end"] + by
    return F.struct(start.alias("start"), end.alias("end"), span["match"].alias("match"))


def _ranked(text: Column, rank: int) -> Column:
    """The spans of one of ``BASE`` as (start, rank, end, kind), without those that are too short."""
    kind, pattern = BASE[rank]
    spans = _spans(text, pattern)
    if kind == "assign":
        secret = F.lit(pattern), F.lit(2)
        spans = F.filter(
            spans, lambda s: F.length(F.call_function("regexp_extract", s["match"], *secret)) >= ASSIGN_LEAST
        )
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def _candidates(text: Column) -> Column:
    """The runs of ``CANDIDATE``, each as an array of one span, or of those of ``PARTS`` where no
    encoding fits the run."""

    def split(s: Column) -> Column:
        parts = F.concat(*[_spans(s["match"], pattern) for pattern in PARTS])
        return F.when(s["match"].rlike(MIXED), F.transform(parts, lambda p: _moved(p, s["start"]))).otherwise(F.array(s))

    return F.transform(_spans(text, CANDIDATE), split)


def _outside(runs: Column, base: Column) -> Column:
    """The spans of runs that no base span overlaps, without runs that have none.

    Base spans are in order of their start: a span is compared with those of the blocks that reach it.
    """

    def clash(s: Column, t: Column) -> Column:
        return (s["start"] < t["end"]) & (t["start"] < s["end"])

    def reach(block: Column) -> Column:
        ends = F.transform(block, lambda s: s["end"])
        return F.struct(F.get(block, 0)["start"].alias("start"), F.array_max(ends).alias("end"), block.alias("spans"))

    def free(blocks: Column) -> Column:
        def hit(t: Column) -> Column:
            return F.exists(blocks, lambda b: F.when(clash(b, t), F.exists(b["spans"], lambda s: clash(s, t))).otherwise(False))

        return F.filter(F.transform(runs, lambda run: F.filter(run, lambda t: ~hit(t))), lambda run: F.size(run) > 0)

    some = F.filter(_blocks(base), lambda b: F.size(b) > 0)
    return _bound(F.transform(some, reach), free)


def _apart(tokens: Column) -> Column:
    """Of the tokens of one run, whose parts may overlap, those least likely ordinary text."""
    kind = "array<struct<p_text:double,start:int,end:int>>"
    ranked = F.array_sort(
        F.transform(tokens, lambda t: F.struct(t["is"]["p_text"].alias("p_text"), t["start"].alias("start"), t["end"].alias("end")))
    )

    def step(kept: Column, t: Column) -> Column:
        clash = F.exists(kept, lambda k: (k["start"] < t["end"]) & (t["start"] < k["end"]))
        return F.when(clash, kept).otherwise(F.array_append(kept, t))

    kept = F.aggregate(ranked, F.array().cast(kind), step)
    return F.transform(kept, lambda k: F.struct(k["start"].alias("start"), k["end"].alias("end")))


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _length_class(n: Column) -> Column:
    found = F.lit(0)
    for i, least in enumerate(LENGTH_CLASSES):
        found = F.when(n >= least, F.lit(i)).otherwise(found)
    return found


def _limits(candidates: DataFrame, rate: float) -> dict[tuple[str, int], float]:
    """The largest p_text that is a discovery, for each encoding and length class.

    Benjamini-Hochberg on the counts of p-values in fixed bins of their logarithm: a bin's upper
    edge p is allowed while (strings tested) * p <= rate * (strings at most p). At most
    ``P_BINS`` counts for each of the few classes reach the driver.
    """
    bins = F.least(F.lit(P_BINS), F.floor(-F.log10(F.greatest("p_text", F.lit(1e-300))) / P_STEP)).cast("int")
    candidates = candidates.where("encoding is not null")
    counted = candidates.groupBy("encoding", "length_class", bins.alias("bin")).count().collect()
    limits = {}
    for group in {(r.encoding, r.length_class) for r in counted}:
        rows = sorted(((r.bin, r["count"]) for r in counted if (r.encoding, r.length_class) == group), reverse=True)
        tested, seen = sum(n for _, n in rows), 0
        for at, n in rows:
            seen += n
            if tested * 10 ** (-at * P_STEP) <= rate * seen:
                limits[group] = 10 ** (-at * P_STEP)
    return limits


def scan_secrets(
    docs: DataFrame, text: str = "text", rate: float = 0.01, least_random: float = 0.001
) -> DataFrame:
    """``docs`` without the text, with ``base`` and ``random``: arrays of (kind, start, end).

    Positions are code points, ends exclusive, over whole texts. ``base`` has the matches of
    ``BASE`` (leftmost, non-overlapping for each kind), ordered by start and kind. ``random`` has
    runs of at least 20 encoding characters outside these spans that look drawn at random: no test
    of ``randomness`` rejects it at ``least_random``, and ordinary strings of the same encoding and
    length class are as even only so seldom that false discoveries stay below ``rate`` among the
    corpus's finds of that class. A run that mixes + or / with _ or - (a URL's path, say) has no
    encoding: its parts without the one and without the other are tested, and of parts that overlap
    the one least likely ordinary is a find. Only built-in functions are used; texts are scanned once, the
    thresholds come from counts over all documents, and no row is shuffled.

    The work is in proportion to the text, also where it is full of matches (``BLOCK``).

    Null and empty texts have no spans. Repeated rows are scanned (and counted) one by one. An
    empty table gives an empty table. The two columns replace those of the same names.
    """
    rest = [c for c in docs.columns if c != text and c.lower() not in ("base", "random")]
    value, found, tokens = fresh(docs, "text_to_scan"), fresh(docs, "base_found"), fresh(docs, "tokens_found")
    rows = docs.select(*[F.col(f"`{c}`") for c in rest], text_of(text).alias(value))
    base = F.array_sort(F.concat(*[_ranked(F.col(value), rank) for rank in range(len(BASE))]))

    def tested(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            _length_class(F.length(s["match"])).alias("length_class"),
            randomness(s["match"]).alias("is"),
        )

    def scan(base: Column) -> Column:
        # What base spans cover is not tested.
        runs = _outside(_candidates(F.col(value)), base)
        return F.struct(base.alias("base"), F.transform(runs, lambda run: F.transform(run, tested)).alias("runs"))

    both = fresh(docs, "spans_found")
    scanned = rows.select(*[F.col(f"`{c}`") for c in rest], _bound(base, scan).alias(both))
    scanned = scanned.select(*[F.col(f"`{c}`") for c in rest], F.col(both)["base"].alias(found), F.col(both)["runs"].alias(tokens))
    scanned = save(scanned, "secret-spans")
    each = scanned.select(F.explode(F.flatten(tokens)).alias("t")).select("t.length_class", "t.is.encoding", "t.is.p_text")
    limits = _limits(each, rate)

    def is_secret(t: Column) -> Column:
        allowed = F.lit(-1.0)
        for (encoding, length_class), limit in sorted(limits.items()):
            here = (t["is"]["encoding"] == encoding) & (t["length_class"] == length_class)
            allowed = F.when(here, F.lit(limit)).otherwise(allowed)
        return (t["is"]["p_random"] >= least_random) & (t["is"]["p_text"] <= allowed)

    def named(kind: Column, s: Column) -> Column:
        return F.struct(kind.alias("kind"), s["start"].alias("start"), s["end"].alias("end"))

    apart = F.flatten(F.transform(tokens, lambda run: _apart(F.filter(run, is_secret))))
    return scanned.select(
        *[F.col(f"`{c}`") for c in rest],
        F.transform(found, lambda s: named(s["kind"], s)).alias("base"),
        F.transform(F.array_sort(apart), lambda s: named(F.lit(RANDOM), s)).alias("random"),
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def by_position(base: Column, extra: Column) -> Column:
    """All spans by start, then kind in the order of ``BASE``, the others last."""
    ranks = F.create_map(*[F.lit(v) for i, (kind, _) in enumerate(BASE) for v in (kind, i)], F.lit(RANDOM), F.lit(len(BASE)))
    ranked = F.transform(
        F.concat(base, extra),
        lambda s: F.struct(s["start"].alias("start"), ranks[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    return F.array_sort(ranked)
