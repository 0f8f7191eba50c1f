"""URL rules: a blocked Bloom filter in front of an exact hash join."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.sizing import BROADCAST_BYTES
from tideline.llm.common import save

WORDS_PER_BLOCK = 8


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    host = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """One bit in each of the block's words, six hash bits each."""
    hashed = F.xxhash64(key, F.lit(1))
    bits = [F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS_PER_BLOCK)]
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), bit) for bit in bits]


class BlockedBloomFilter:
    """Blocks of eight 64-bit words, kept as rows; a key sets one bit in each word of one block.

    A lookup is one equality join on the block number and eight bit tests. The filter has
    ``bits_per_key`` bits for each key; blocks no key fell into have no row. It is broadcast only
    while all its blocks fit in ``BROADCAST_BYTES``; a larger one is shuffled by block.
    """

    def __init__(self, keys: DataFrame, key: str, bits_per_key: int = 16):
        # No table has columns of these names yet.
        self.block = f"bloom_{uuid.uuid4().hex[:12]}"
        self.words = [f"{self.block}_{i}" for i in range(WORDS_PER_BLOCK)]
        keys = keys.where(F.col(key).isNotNull())
        self.blocks = max(1, -(-keys.count() * bits_per_key // (64 * WORDS_PER_BLOCK)))
        masked = keys.select(
            _block(F.col(key), self.blocks).alias(self.block),
            *[mask.alias(word) for word, mask in zip(self.words, _masks(F.col(key)))],
        )
        words = [F.bit_or(word).alias(word) for word in self.words]
        self.table = save(masked.groupBy(self.block).agg(*words), "bloom")
        self.bytes = self.blocks * 8 * (WORDS_PER_BLOCK + 1)

    def small(self) -> bool:
        """Whether all blocks together may be broadcast."""
        return self.bytes <= BROADCAST_BYTES

    def _met(self, rows: DataFrame, key: str, how: str) -> tuple[DataFrame, Column]:
        table = F.broadcast(self.table) if self.small() else self.table
        met = rows.withColumn(self.block, _block(F.col(key), self.blocks)).join(table, self.block, how)
        hit = F.lit(True)
        for word, mask in zip(self.words, _masks(F.col(key))):
            hit = hit & (F.col(word).bitwiseAND(mask) == mask)
        return met, hit

    def possible(self, rows: DataFrame, key: str, keep_word: bool = False) -> DataFrame:
        """The rows whose key may be listed: all that are, and few others.

        ``keep_word`` keeps the first of ``words``, for conditions that must not be moved in front of
        the lookup.
        """
        met, hit = self._met(rows, key, "inner")
        return met.where(hit).select(*rows.columns, *(self.words[:1] if keep_word else []))

    def impossible(self, rows: DataFrame, key: str) -> DataFrame:
        """The other rows: no key of theirs is listed."""
        met, hit = self._met(rows, key, "left")
        return met.where(~F.coalesce(hit, F.lit(False))).select(rows.columns)


def url_verdicts(
    pages: DataFrame, listed: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with host, path, rule and verdict of each URL.

    ``listed`` holds canonical URLs (host string, path string, verdict string). One fits a URL if
    its host is the URL's or a parent domain of it and the URL's path begins with its path; of
    several the longest wins (of equally long ones the greater text, then the greater verdict).

    Every URL is looked up under the parent domains and path lengths that the list has. The Bloom
    filter passes possible hits, an exact join removes the false ones. Pages and their best rules
    meet by URL.

    A null URL, or one without ``://``, has empty host and path. URLs that nothing listed fits have
    a null rule and the ``default`` verdict; so do all for an empty list. Listed rows with a null or
    empty host are ignored, a null path is the empty path. Repeated rows are judged one by one.
    The four columns replace those of the same names.
    """
    rules = listed.select(
        F.translate(F.col("host"), string.ascii_uppercase, string.ascii_lowercase).alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
    ).where(F.length("rule_host") > 0)
    rules = save(rules.withColumn("rule", F.concat("rule_host", "rule_path")).distinct(), "url-rules")
    shape = rules.agg(
        F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths"),
    ).first()
    bloom = BlockedBloomFilter(rules.select("rule").distinct(), "rule")

    labels = F.split(url_host(F.col("url")), r"\.")
    urls = pages.select(F.col(f"`{url}`").alias("url")).where(F.instr("url", "://") > 0)
    urls = urls.withColumns({"labels": labels, "path": url_path(F.col("url"))})
    starts = F.sequence(F.greatest(F.lit(1), F.size("labels") - F.lit((shape.labels or 1) - 1)), F.size("labels"))
    hosts = F.transform(starts, lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))
    lengths = F.array(*[F.lit(n) for n in shape.lengths]).cast("array<int>")
    paths = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substr(F.col("path"), F.lit(1), n)
    )
    keys = F.array_distinct(F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p)))))
    lookups = urls.select("url", F.explode(keys).alias("rule"))
    hits = bloom.possible(lookups, "rule").join(rules.select("rule", "rule_verdict"), "rule")
    best = hits.groupBy("url").agg(F.max(F.struct(F.length("rule"), "rule", "rule_verdict")).alias("best"))
    best = save(best.select("url", "best.rule", "best.rule_verdict"), "url-hits")

    new = ("host", "path", "rule", "verdict")
    rest = [F.col(f"p.`{c}`") for c in pages.columns if c.lower() not in new]
    met = pages.alias("p").join(best.alias("b"), F.col(f"p.`{url}`") == F.col("b.url"), "left")
    return met.select(
        *rest,
        url_host(F.col(f"p.`{url}`")).alias("host"),
        url_path(F.col(f"p.`{url}`")).alias("path"),
        F.col("b.rule").alias("rule"),
        F.coalesce("b.rule_verdict", F.lit(default)).alias("verdict"),
    )
