"""Near-duplicates: a chosen-path set similarity join over word shingles."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import fresh, raw_bytes, release, save, slices, text_of
from tideline.llm.components import connected_components
from tideline.llm.urls import BlockedBloomFilter


@dataclass(frozen=True)
class Join:
    """Parameters of the join.

    ``trees`` independent trees of at most ``depth`` levels. A node of up to ``leaf`` members is
    compared exhaustively; a larger one branches. All links between members of large nodes of
    level ``hot`` are looked for by prefixes of their sets: a token's list of up to ``block`` members in one
    piece, a longer one in blocks of about as many.

    Comparisons in nodes are of sketches of ``places`` bytes. Pairs that agree in fewer than
    ``likely`` of the places are not compared on their sets: at a similarity of 0.8 the share that agrees is
    below that four standard deviations under its mean, in 3 of 100,000 pairs.
    """

    words: int = 5
    similar: int = 80
    trees: int = 16
    depth: int = 5
    hot: int = 2
    leaf: int = 48
    block: int = 1024
    places: int = 256
    likely: float = 0.70


def shingles(text: bytes, words: int) -> np.ndarray:
    """The sorted distinct hashes of the text's word shingles, A-Z lower-cased; fewer words than
    that are one shingle, none are no shingle."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = max(1, len(hashes) - words + 1)
    rolled = np.full(n, len(hashes) if len(hashes) < words else words, np.uint64)
    for i in range(min(words, len(hashes))):
        rolled = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + hashes[i : i + n]
    rolled = (rolled ^ (rolled >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return np.unique(rolled ^ (rolled >> np.uint64(31)))


@lru_cache(maxsize=2)
def _multipliers(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    odd = rng.integers(0, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd[:, None], rng.integers(0, 1 << 63, hashes, dtype=np.uint64)[:, None]


def minwise(shingled: np.ndarray, hashes: int) -> np.ndarray:
    """For each hash function the token it selects, as 32 bits."""
    times, plus = _multipliers(hashes)
    least = np.full(hashes, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingled), 4096):  # long texts a piece at a time
        part = shingled[None, at : at + 4096]
        mixed = (part ^ (part >> np.uint64(33))) * times + plus
        np.minimum(least, mixed.min(axis=1), out=least)
    # The least value of a multiplicative hash has its high bits near zero: the low ones tell tokens apart.
    least = (least ^ (least >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (least >> np.uint64(32)).astype(np.uint32)


def _set_key(shingled: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingled.tobytes())


def _profiles(docs: DataFrame, join: Join) -> DataFrame:
    """(id, n_shingles, key, tokens, sketch): the set's key (null if empty), the tokens that choose
    its paths (32 bits for the roots' children, 16 for each level below) and its sketch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in slices(batches):
            sets = [shingles(t, join.words) for t in raw_bytes(batch.column(1))]
            keys, tokens, sketches = [], [], []
            for s in sets:
                chosen = minwise(s, max(join.places, join.trees * join.depth)) if len(s) else None
                keys.append(_set_key(s) if len(s) else None)
                paths = chosen[: join.trees * join.depth].reshape(join.trees, join.depth) if len(s) else None
                tokens.append(paths[:, 0].tobytes() + paths[:, 1:].astype(np.uint16).tobytes() if len(s) else None)
                # Places use other bits than paths do.
                sketches.append((chosen[: join.places] >> np.uint32(24)).astype(np.uint8).tobytes() if len(s) else None)
            made = [pa.array(map(len, sets), pa.int64()), *(pa.array(c, pa.binary()) for c in (keys, tokens, sketches))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *made], names=["id", "n_shingles", "key", "tokens", "sketch"]
            )

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(work, f"id {id_type}, n_shingles bigint, key binary, tokens binary, sketch binary")


def _members(classes: DataFrame, join: Join) -> DataFrame:
    """One row per class and tree: (node, key, path): the root's child that its first token chose,
    and the tokens for the levels below."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = np.arange(join.trees, dtype=np.uint64)[None, :] << np.uint64(32)
        wide, narrow = 4 * join.trees, 2 * (join.depth - 1)
        for batch in slices(batches, 2048):
            tokens = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            first = np.ascontiguousarray(tokens[:, :wide]).view(np.uint32)
            node = (tree | first.astype(np.uint64)).view(np.int64)
            key = batch.column("key").take(pa.array(np.repeat(np.arange(batch.num_rows), join.trees)))
            paths = [row.tobytes() for row in tokens[:, wide:].reshape(-1, narrow)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node.reshape(-1)), key, pa.array(paths, pa.binary())], names=["node", "key", "path"]
            )

    return classes.select("key", "tokens").mapInArrow(work, "node bigint, key binary, path binary")


def _agreement(sketches: np.ndarray) -> np.ndarray:
    """The share of places in which rows of one-byte sketches agree, chance agreement taken off."""
    equal = (sketches[:, None, :] == sketches[None, :, :]).mean(axis=2)
    return (equal - 1 / 256) / (1 - 1 / 256)


_PAIR = ["a", "b", "about", "of_a", "of_b"]
_PAIR_SCHEMA = "a binary, b binary, about float, of_a binary, of_b binary"


def _pairs_batch(found: list[tuple]) -> pa.RecordBatch:
    """Pairs (key, component, key, component, agreement), the smaller key first."""
    rows = [(a, b, s, of_a, of_b) if a < b else (b, a, s, of_b, of_a) for a, of_a, b, of_b, s in found]
    kinds = (pa.binary(), pa.binary(), pa.float32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 5, kinds)], names=_PAIR)


def _leaf_pairs(members: DataFrame, join: Join) -> DataFrame:
    """Likely pairs of different components within each leaf, compared exhaustively on their sketches."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for keys, parts, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                agree = np.triu(_agreement(np.frombuffer(b"".join(tokens), np.uint8).reshape(len(keys), -1)), 1)
                for i, j in zip(*np.nonzero(agree >= join.likely)):
                    if parts[i] != parts[j]:
                        found.append((keys[i], parts[i], keys[j], parts[j], agree[i, j]))
            yield _pairs_batch(found)

    lists = [F.collect_list(c).alias(c) for c in ("key", "of", "sketch")]
    return members.groupBy("node").agg(*lists).drop("node").mapInArrow(work, _PAIR_SCHEMA)


def _star_pairs(met: DataFrame, join: Join) -> DataFrame:
    """Likely pairs among (key, sketch, centre, centre_sketch) rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            keys, centres = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            left = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            right = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            agree = ((left == right).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
            likely = [i for i in np.flatnonzero(agree >= join.likely) if keys[i] != centres[i]]
            yield _pairs_batch([(keys[i], keys[i], centres[i], centres[i], agree[i]) for i in likely])

    return met.select("key", "sketch", "centre", "centre_sketch").mapInArrow(work, _PAIR_SCHEMA)


def _distinct(pairs: DataFrame) -> DataFrame:
    """Trees find the same pairs again."""
    return pairs.groupBy("a", "b").agg(
        F.max("about").alias("about"), F.first("of_a").alias("of_a"), F.first("of_b").alias("of_b")
    )


def _below(node: Column, path: Column, level: int) -> Column:
    """The child that the token of this level chooses."""
    return F.xxhash64(node, F.substring(path, 2 * level + 1, 2))


def _nodes(classes: DataFrame, join: Join) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The trees: members of the roots' small children, of small nodes below, and of large nodes.

    Level by level: nodes of one member end; small ones are leaves; members of large ones go to the
    children their next tokens choose. Where thousands of documents resemble each other, nodes do
    not get small: on the last level large ones are dealt out by hash into leaves, differently in
    every tree.
    """
    members = save(_members(classes, join), "near-members-0")
    first, leaves, larger = None, [], []
    for level in range(join.depth):
        sizes = members.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        sized = members.join(save(sizes, f"near-sizes-{level}"), "node")
        if level == 0:  # few rows are left: they take their sketches along
            sized = sized.join(classes.select("key", "sketch"), "key")
        sized = save(sized.select("node", "key", "path", "size", "sketch"), f"near-sized-{level}")
        small = sized.where(F.col("size") <= join.leaf)
        large = sized.where(F.col("size") > join.leaf)
        larger.append(large.withColumn("level", F.lit(level)))
        if level == 0:
            first = small
        else:
            leaves.append(small)
        if level < join.depth - 1:
            below = large.select(_below(F.col("node"), F.col("path"), level).alias("node"), "key", "path", "sketch")
            members = save(below, f"near-members-{level + 1}")
            if members.isEmpty():
                break
    else:
        parts = F.ceil(F.col("size") * 2 / join.leaf).cast("bigint")
        dealt = F.xxhash64("node", F.pmod(F.xxhash64("node", "key"), parts))
        leaves.append(large.withColumn("node", dealt))
    leaves = reduce(DataFrame.unionByName, leaves or [first.limit(0)])
    return first, leaves, save(reduce(DataFrame.unionByName, larger), "near-large")


def _stars(large: DataFrame, join: Join) -> DataFrame:
    """Likely pairs of the members of large nodes with the centre of their node: the member that is
    in large nodes most often, which is the text that the others vary, if it is there."""
    often = save(large.groupBy("key").agg(F.sum(F.log2("size")).alias("often")), "near-often")
    ranked = save(large.join(often, "key"), "near-ranked")
    chosen = ranked.groupBy("level", "node").agg(F.max(F.struct("often", "key", "sketch")).alias("best"))
    chosen = chosen.select("level", "node", F.col("best.key").alias("centre"), F.col("best.sketch").alias("centre_sketch"))
    met = ranked.join(save(chosen, "near-centres"), ["level", "node"])
    return save(_distinct(_star_pairs(met, join)), "near-stars")


def _sets(keys: DataFrame, classes: DataFrame, docs: DataFrame, join: Join) -> DataFrame:
    """(key, shingles) of the given classes, from the text of one row of each.

    A Bloom filter of the wanted ids keeps other texts out of the shuffle while it is small enough
    to broadcast; an exact join by id follows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(t, join.words) for t in raw_bytes(batch.column(1))]
            # Another row may repeat the id with another text.
            right = [key == _set_key(s) for key, s in zip(batch.column(0).to_pylist(), sets)]
            made = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["key", "shingles"]
            )
            yield made.filter(pa.array(right))

    wanted = save(keys.join(classes.select("key", "first"), "key"), "near-wanted")
    bloom = BlockedBloomFilter(wanted, "first")
    some = bloom.possible(docs, "id") if bloom.small() else docs
    # Shuffled at every size: texts are too large to be sent to all.
    texts = some.hint("merge").join(wanted, some["id"] == wanted["first"]).select("key", "text")
    return save(texts.mapInArrow(work, "key binary, shingles binary").dropDuplicates(["key"]), "near-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Those of the (a, b, of_a, of_b) rows whose whole sets are similar enough."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            kept = []
            for left, right in zip(*(c.to_pylist() for c in batch.columns[4:])):
                left, right = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                both = len(np.intersect1d(left, right, assume_unique=True))
                kept.append(100 * both >= join.similar * (len(left) + len(right) - both))
            made = pa.RecordBatch.from_arrays(batch.columns[:4], names=["a", "b", "of_a", "of_b"])
            yield made.filter(pa.array(kept, pa.bool_()))

    met = pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("left")), "a")
    met = met.join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("right")), "b")
    names = ["a", "b", "of_a", "of_b"]
    return save(
        met.select(*names, "left", "right").mapInArrow(work, "a binary, b binary, of_a binary, of_b binary"),
        "near-links",
    )


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()


def _best_pairs(pairs: DataFrame) -> DataFrame:
    """For every class the pair that looks most alike."""
    ends = pairs.select(F.col("a").alias("end"), "*").unionByName(pairs.select(F.col("b").alias("end"), "*"))
    best = ends.groupBy("end").agg(F.max(F.struct("about", "a", "b", "of_a", "of_b")).alias("best"))
    return best.select("best.*").distinct()


def _between(pairs: DataFrame, moved: DataFrame) -> DataFrame:
    """The pairs with their components moved on, without those that are in one component now."""
    for end in ("of_a", "of_b"):
        onward = moved.select(F.col("node").alias(end), F.col("component").alias("onward"))
        pairs = pairs.join(onward, end, "left").withColumn(end, F.coalesce("onward", end)).drop("onward")
    return pairs.where("of_a <> of_b")


def _labelled(members: DataFrame, parts: DataFrame) -> DataFrame:
    """The members with their component (their own key if they are linked with nothing yet)."""
    named = parts.select("key", F.col("component").alias("of"))
    return members.join(named, "key", "left").withColumn("of", F.coalesce("of", "key"))


class _Linked:
    """The components (key, component) that confirmed links have made so far."""

    def __init__(self, classes: DataFrame, docs: DataFrame, join: Join):
        self.classes, self.docs, self.join = classes, docs, join
        self.sets = self.parts = None

    def know(self, keys: DataFrame) -> None:
        """Read the sets of the classes that are not known yet."""
        if self.sets is None:
            self.sets = _sets(keys, self.classes, self.docs, self.join)
            self.parts = save(self.sets.select("key", F.col("key").alias("component")), "near-parts")
            return
        more = _sets(keys.join(self.sets.select("key"), "key", "left_anti"), self.classes, self.docs, self.join)
        self.sets = self.sets.unionByName(more)
        own = more.select("key", F.col("key").alias("component"))
        self.parts = save(self.parts.unionByName(own), "near-parts")

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Compare pairs on whole sets and join the components of those that are links; returns the
        moves (node, component)."""
        links = _confirmed(pairs.drop("about"), self.sets, self.join)
        moved = connected_components(links.select("of_a", "of_b"), "of_a", "of_b", "near")
        steps = moved.select(F.col("node").alias("component"), F.col("component").alias("onward"))
        met = self.parts.join(steps, "component", "left")
        self.parts = save(met.select("key", F.coalesce("onward", "component").alias("component")), "near-parts")
        return moved


def _joined(classes: DataFrame, docs: DataFrame, join: Join) -> DataFrame:
    """(key, component) of the classes that met a likely partner.

    A pair whose ends are in one component already could not change anything: it is never made
    where that is known, and not compared. So the links that join most come first. First the
    members of large nodes are compared with the centres. Then leaves are compared, exhaustively but
    for pairs of one component; of these pairs every class's best one is confirmed first, and
    then all that still lie between components.

    What the leaves below a large node may miss is then looked for among the members of the large
    nodes of level ``hot``, whatever their size: with rare tokens first in every set, a linked pair shares a token
    of the front of both sets (``_prefixes``). Short lists of such a token give all pairs that can be
    links by their sizes and by where the token stands in them; in long ones, what is outside the largest
    component is compared with the whole list on sketches.
    """
    first, leaves, large = _nodes(classes, join)
    linked = _Linked(classes, docs, join)
    stars = _stars(large, join)
    linked.know(_ends(stars))
    linked.confirm(stars)
    pairs = _leaf_pairs(first.withColumn("of", F.col("key")).drop("path", "size"), join)
    below = _leaf_pairs(_labelled(leaves.drop("path", "size"), linked.parts), join)
    moves = linked.parts.where("key <> component").select(F.col("key").alias("node"), "component")
    opened = save(_distinct(_between(pairs, moves).unionByName(below)), "near-open")
    linked.know(_ends(opened))
    best = save(_best_pairs(opened), "near-best")
    moved = linked.confirm(best)
    left = save(_between(opened.join(best.select("a", "b"), ["a", "b"], "left_anti"), moved), "near-open")
    linked.confirm(left)
    hot = large.where(F.col("level") == min(join.hot, join.depth - 1))
    if hot.isEmpty():
        return linked.parts
    linked.know(hot.select("key").distinct())
    tried = save(stars.select("a", "b").unionByName(opened.select("a", "b")).distinct(), "near-tried")
    prefixes = save(_prefixes(linked.sets.join(hot.select("key").distinct(), "key"), join), "near-prefixes")
    more = _distinct(_list_pairs(_lists(_labelled(prefixes, linked.parts)).where(F.col("m") <= join.block), join))
    linked.confirm(save(more.join(tried, ["a", "b"], "left_anti"), "near-prefix-pairs"))
    long = _lists(_labelled(prefixes, linked.parts)).where(F.col("m") > join.block)
    more = _distinct(_long_list_pairs(save(long, "near-long-lists"), classes, join))
    linked.confirm(save(more.join(tried, ["a", "b"], "left_anti"), "near-long-pairs"))
    return linked.parts


# Counters of the sketch that orders tokens, and sketches that one merging task takes.
_COUNTERS, _FAN_IN = 1 << 18, 16


def _counter_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - 18)).astype(np.int64)


def _rarity(sets: DataFrame) -> np.ndarray:
    """How often tokens occur, in counters that tokens share by hash: one sketch a task, added up as a tree.

    It only decides which order tokens are taken in; any order gives the same links.
    """

    def packed(counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"counts": [zlib.compress(counts.tobytes(), 1)]})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_COUNTERS, np.int64)
        for batch in slices(batches, 64):
            tokens = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)
            counts += np.bincount(_counter_of(tokens), minlength=_COUNTERS)
        yield packed(counts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_COUNTERS, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                counts += np.frombuffer(zlib.decompress(blob), np.int64)
        yield packed(counts)

    sketches, parts = sets.select("shingles").mapInArrow(count, "counts binary"), sets.rdd.getNumPartitions()
    while parts > 1:
        parts = -(-parts // _FAN_IN)
        sketches = sketches.repartition(parts).mapInArrow(merge, "counts binary")
    total = np.zeros(_COUNTERS, np.int64)
    for row in sketches.collect():
        total += np.frombuffer(zlib.decompress(bytes(row.counts)), np.int64)
    return total


def _prefixes(sets: DataFrame, join: Join) -> DataFrame:
    """(token, key, n, at, first): the front of each set of n tokens, in one order of all tokens, rare
    ones first, and the token's place in it.

    Sets x and y are linked if they share c >= s (|x| + |y|) / (1 + s) tokens, so c >= s |x|, and for the smaller
    one c >= 2 s |x| / (1 + s). All but c - 1 tokens of a set hold a shared one: so the first that the
    pair shares is within the first |x| - s |x| + 1 of the larger set, and within the even shorter front of the
    smaller one, which ``first`` marks.
    """
    sets = save(sets.select("key", "shingles"), "near-hot-sets")
    rarity = sets.sparkSession.sparkContext.broadcast(_rarity(sets))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = rarity.value
        for batch in slices(batches, 256):
            tokens, sizes, places, first = [], [], [], []
            for shingled in batch.column(1).to_pylist():
                found = np.frombuffer(shingled, np.uint64)
                n = len(found)
                longer = n + join.similar * n // -100 + 1
                shorter = n + 2 * join.similar * n // -(100 + join.similar) + 1
                tokens.append(found[np.lexsort((found, counts[_counter_of(found)]))[:longer]].view(np.int64))
                sizes.append(n)
                places.append(np.arange(longer))
                first.append(np.arange(longer) < shorter)
            of = np.repeat(np.arange(len(sizes)), list(map(len, places)))
            made = [pa.array(np.concatenate(tokens)), batch.column(0).take(pa.array(of)), pa.array(np.array(sizes)[of])]
            made += [pa.array(np.concatenate(places)), pa.array(np.concatenate(first))]
            yield from slices([pa.RecordBatch.from_arrays(made, names=["token", "key", "n", "at", "first"])], 65536)

    return sets.mapInArrow(work, "token bigint, key binary, n bigint, at bigint, first boolean")


def _lists(prefixes: DataFrame) -> DataFrame:
    """The rows of tokens that members of different components have, one of them in its shorter
    front, with the number ``m`` of them."""
    labelled = save(prefixes, "near-labelled")
    counts = labelled.groupBy("token").agg(
        F.count(F.lit(1)).alias("m"),
        F.max("first").alias("any_first"),
        (F.min("of") < F.max("of")).alias("differ"),
    )
    counts = counts.where("any_first and differ").select("token", "m")
    return labelled.join(save(counts, "near-token-counts"), "token")


def _can_link(n, at, first, i, others: np.ndarray, join: Join) -> np.ndarray:
    """Which of the others can be linked with the i-th by sizes and places: the smaller set has the token in
    its shorter front, and behind it there are enough tokens in both."""
    smaller, larger = np.minimum(n[i], n[others]), np.maximum(n[i], n[others])
    in_front = (first[i] & (n[i] <= n[others])) | (first[others] & (n[others] <= n[i]))
    left = np.minimum(n[i] - at[i], n[others] - at[others])
    return in_front & (100 * smaller >= join.similar * larger) & ((100 + join.similar) * left >= join.similar * (smaller + larger))


def _list_pairs(members: DataFrame, join: Join) -> DataFrame:
    """All pairs of different components in the tokens' lists that can be links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            found = []
            for keys, parts, *numbers in zip(*(c.to_pylist() for c in batch.columns)):
                n, at, first = map(np.array, numbers)
                _, of = np.unique(np.array(parts, object), return_inverse=True)
                for i in range(len(keys) - 1):
                    others = np.arange(i + 1, len(keys))
                    others = others[of[others] != of[i]]
                    for j in others[_can_link(n, at, first, i, others, join)]:
                        found.append((keys[i], parts[i], keys[j], parts[j], 1.0))
                    if len(found) > 4096:
                        yield _pairs_batch(found)
                        found = []
            yield _pairs_batch(found)

    lists = [F.collect_list(c).alias(c) for c in ("key", "of", "n", "at", "first")]
    return members.groupBy("token").agg(*lists).drop("token").mapInArrow(work, _PAIR_SCHEMA)


def _long_list_pairs(members: DataFrame, classes: DataFrame, join: Join) -> DataFrame:
    """Likely pairs of different components in lists too long for one task, compared on their sketches.

    Of a list's largest component and the rest, only the rest asks: in blocks of about ``block``,
    each of which meets all members of the list, in blocks too.
    """
    names = ("key", "of", "n", "at", "first", "sketch", "asks")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4):
            for keys, parts, *numbers, tokens, asks in zip(*(batch.column(c).to_pylist() for c in names)):
                n, at, first, asks = map(np.array, (*numbers, asks))
                sketches = np.frombuffer(b"".join(tokens), np.uint8).reshape(len(keys), -1)
                _, of = np.unique(np.array(parts, object), return_inverse=True)
                asked, found = np.flatnonzero(~asks), []
                for i in np.flatnonzero(asks):
                    others = asked[of[asked] != of[i]]
                    others = others[_can_link(n, at, first, i, others, join)]
                    agree = ((sketches[others] == sketches[i]).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
                    for j, about in zip(others[agree >= join.likely], agree[agree >= join.likely]):
                        found.append((keys[i], parts[i], keys[j], parts[j], about))
                    if len(found) > 4096:
                        yield _pairs_batch(found)
                        found = []
                yield _pairs_batch(found)

    parts = members.groupBy("token", "of").agg(F.count(F.lit(1)).alias("of_part"))
    lists = parts.groupBy("token").agg(F.max(F.struct("of_part", "of")).alias("top"), F.sum("of_part").alias("size"))
    lists = lists.select(
        "token",
        F.col("top.of").alias("top"),
        F.ceil((F.col("size") - F.col("top.of_part")) / join.block).cast("bigint").alias("askers"),
        F.ceil(F.col("size") / join.block).cast("bigint").alias("blocks"),
    )
    met = members.join(save(lists, "near-long-tokens"), "token").join(classes.select("key", "sketch"), "key")
    met = save(met, "near-long-members")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    dealt = lambda n: F.pmod(F.xxhash64("token", "key"), F.col(n))
    row = ["token", "key", "of", "n", "at", "first", "sketch"]
    asking = met.where("of <> top").select(*row, dealt("askers").alias("asker"), every("blocks").alias("block"), F.lit(True).alias("asks"))
    asked = met.select(*row, every("askers").alias("asker"), dealt("blocks").alias("block"), F.lit(False).alias("asks"))
    groups = asking.unionByName(asked).groupBy("token", "asker", "block").agg(*[F.collect_list(c).alias(c) for c in names])
    return groups.where(F.exists("asks", lambda m: m)).select(*names).mapInArrow(work, _PAIR_SCHEMA)


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", join: Join = Join()
) -> DataFrame:
    """(id, n_shingles, key, component_id, kept) of every row.

    Rows are linked if the sets of their word shingles have a similarity (intersection over union)
    of ``join.similar`` percent or more; ``component_id`` is the smallest id that links reach, and
    the row with that id is kept. Equal sets are one class from the start, so copies never make pairs.

    Candidates come from the chosen-path join (``_nodes``, ``_joined``), links from whole sets. Two classes
    with similarity s meet in a tree's first level with probability s, so those that share no large
    node are missed with (1 - s) ** trees: less than one in 10**11 at 0.8. Those that share no large node of
    level 2 either are missed with up to (1 - s**3) ** trees, 1 in 100,000 at 0.8. All trees share one
    sketch: its filter misses 3 in 100,000 at 0.8, but for pairs with a rare token in hot nodes.

    Null and empty texts, and texts without words, have an empty set and are linked with nothing.
    A row without an id is linked with nothing either: component null, kept. Rows that repeat an id
    share one verdict for each set. An empty table gives an empty table. Other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), text_of(text).alias("text"))
    profiles = save(_profiles(rows, join), "near-profiles")
    named = profiles.where(F.col("key").isNotNull() & F.col("id").isNotNull())
    classes = named.groupBy("key").agg(
        F.min("id").alias("first"),
        F.count(F.lit(1)).alias("copies"),
        F.first("tokens").alias("tokens"),
        F.first("sketch").alias("sketch"),
    )
    classes = save(classes, "near-classes")
    parts = _joined(classes, rows, join)
    joined = classes.select("key", "first", "copies").join(parts, "key", "left")
    # Only classes with links or copies need a row here.
    joined = joined.where("component is not null or copies > 1")
    joined = save(joined.select("key", "first", F.coalesce("component", "key").alias("component")), "near-joined")
    least = save(joined.groupBy("component").agg(F.min("first").alias("least")), "near-least")
    where = save(joined.join(least, "component").select("key", F.col("least").alias("component_id")), "near-where")
    verdicts = profiles.select("id", "n_shingles", "key").join(where, "key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return verdicts.select(
        "id", "n_shingles", "key", component.alias("component_id"), (F.col("id").eqNullSafe(component)).alias("kept")
    )


def without_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", join: Join = Join()
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Where an id repeats with different texts, each text has a verdict of its own: lost rows are
    found by id first, and compared by set where an id has lost one set and kept another.
    """
    found = save(near_duplicates(docs, id_column, text, join).select("id", "key", "kept"), "near-verdicts")
    lost_id = fresh(docs, "lost_id")
    verdicts = found.where("id is not null").groupBy(F.col("id").alias(lost_id)).agg(
        F.max("kept").alias("kept"), F.max(~F.col("kept")).alias("lost")
    )
    lost = save(verdicts.where("lost").select(lost_id, F.col("kept").alias("split")), "near-lost")
    same = F.col(f"`{id_column}`") == F.col(lost_id)
    rest = docs.join(lost.drop("split"), same, "left_anti")
    split = lost.where("split").drop("split")
    if split.isEmpty():
        return rest
    # Ids that repeat: their rows, with the keys of their sets, against the sets that stay.
    mark = fresh(docs, "set_key")
    stays = found.where("kept").join(split, F.col("id") == F.col(lost_id), "left_semi").select(F.col("id").alias(lost_id), "key")
    stays = stays.withColumnRenamed("key", mark).distinct()
    place = fresh(docs, "place")
    doubtful = save(docs.join(split, same, "left_semi").withColumn(place, F.monotonically_increasing_id()), "near-doubtful")
    keys = _profiles(doubtful.select(F.col(place).alias("id"), text_of(text).alias("text")), join)
    keys = keys.select(F.col("id").alias(place), F.col("key").alias(f"{mark}_own"))
    met = doubtful.join(keys, place).join(
        stays, same & F.col(f"{mark}_own").eqNullSafe(F.col(mark)), "left_semi"
    )
    return rest.unionByName(met.select(*[F.col(f"`{c}`") for c in docs.columns]))
