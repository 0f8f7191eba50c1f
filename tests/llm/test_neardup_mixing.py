"""Similarity join, components and mixing against plain Python."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import neardup
from tideline.llm.components import connected_components
from tideline.llm.mixing import Target, in_blocks, mix_order, mix_sources, mixed_rows, plan_mix
from tideline.llm.neardup import Join, _can_link, _prefixes, _rarity, near_duplicates, without_near_duplicates
from tideline.llm.packing import pack
from tideline.llm.queries import tokenizer_path


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def shingle_set(text, k):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute_force(rows, k):
    sets = {key: shingle_set(text, k) for key, text in rows}
    links = []
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            links.append((a, b))
    where = components(sets, links)
    return {key: (len(sets[key]), where[key], where[key] == key) for key in sets}


def varied(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("k", [4, 5])
def test_groups_copies_and_passages(spark, k):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, varied(rng, base, rng.randrange(6))) for i in range(120)]  # a group around a text
    rows += [(1000 + i, " ".join(base)) for i in range(40)]  # copies of that text
    rows += [(2000 + i, passage + " " + " ".join(f"x{rng.randrange(10**6)}" for _ in range(40))) for i in range(120)]
    rows += [(3000, "a b c"), (3001, "A B  c"), (3002, "a b"), (3003, ""), (3004, None), (3005, " \n"), (3006, "é b c"), (3007, "É b c")]
    chain = [f"c{i}" for i in range(200)]
    for i in range(12):  # neighbours are linked, ends are not
        rows.append((4000 + i, " ".join(chain[6 * i : 6 * i + 100])))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    small = Join(words=k, leaf=12, block=64, depth=4)  # so that every branch of the join is taken
    want = brute_force(rows, k)
    for join in (Join(words=k), small):
        got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, join=join).collect()}
        assert got == want
    extra = docs.withColumn("lost_id", F.lit(1)).withColumn("key", F.lit(2))
    kept = without_near_duplicates(extra, join=Join(words=k))
    assert kept.columns == extra.columns
    assert {r.doc_id for r in kept.collect()} == {key for key, v in want.items() if v[2]}


def test_links_among_documents_that_share_a_passage(spark):
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(104)]
    own = lambda n: [f"x{rng.randrange(10**9)}" for _ in range(n)]
    rows = [(i, " ".join(passage + own(20))) for i in range(500)]  # no two are linked: 0.72
    for i in range(0, 400, 2):  # 200 true pairs: 0.81
        tail = own(7)
        rows += [(10**4 + i + k, " ".join(passage + tail + own(13))) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    join = Join(words=4, leaf=12, block=64, depth=4)
    got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, join=join).collect()}
    assert got == brute_force(rows, 4)


def test_links_that_only_common_tokens_make(spark):
    rng = random.Random(6)
    parts = [[f"s{i}w{j}" for j in range(12)] for i in range(24)]
    rows = []
    for i in range(300):  # all sizes are equal: no member is at the rim of a larger group
        left_out = set(rng.sample(range(24), 4))
        rows.append((i, " ".join(w for at, part in enumerate(parts) if at not in left_out for w in part)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    join = Join(words=4, leaf=12, block=64, depth=4)
    got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, join=join).collect()}
    assert got == brute_force(rows, 4)


def test_null_ids_repeats_long_texts_and_nothing(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text), (7, text), (7, text), (5, text), (7, "quite another text than that one"), (9, "v " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.id, r.component_id, r.kept) for r in near_duplicates(docs).collect()), key=str)
    assert got == sorted(
        [(None, None, True), (7, 5, False), (7, 5, False), (5, 5, True), (7, 7, True), (9, 9, True)], key=str
    )
    assert near_duplicates(docs.limit(0)).count() == 0
    lone = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert near_duplicates(lone).first().kept
    # The stage keeps the text that an id has beside the one it loses.
    rows += [(7, None), (7, text + " more"), (8, text)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string").withColumn("lost_id", F.lit(1))
    kept = sorted(((r.doc_id, r.text) for r in without_near_duplicates(docs).select("doc_id", "text").collect()), key=str)
    assert kept == sorted(
        [(None, text), (5, text), (7, "quite another text than that one"), (7, None), (9, "v " * 200_000)], key=str
    )


def test_prefixes_hold_a_token_of_every_link(spark):
    """Of all linked pairs, the token that they share first passes the rules for sizes and places."""
    rng = random.Random(8)
    base = rng.sample(range(1 << 60), 60)
    sets = [sorted(set(rng.sample(base, rng.randint(44, 60)) + rng.sample(range(1 << 60), rng.randint(0, 8)))) for _ in range(120)]
    rows = [(str(i).encode(), np.array(s, np.uint64).tobytes()) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "key binary, shingles binary").repartition(20)
    join = Join()
    total = _rarity(df)
    assert total.sum() == sum(map(len, sets))
    lists = defaultdict(dict)
    for r in _prefixes(df, join).collect():
        lists[r.token][int(r.key)] = (r.n, r["at"], r["first"])
        assert r.n == len(sets[int(r.key)])
    links = 0
    for a, b in combinations(range(len(sets)), 2):
        both = len(set(sets[a]) & set(sets[b]))
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            links += 1
            met = [l for l in lists.values() if a in l and b in l]
            n, at, first = (np.array(c) for c in zip(*[(l[a], l[b]) for l in [min(met, key=lambda l: l[a][1])]][0]))
            assert _can_link(n, at, first, 0, np.array([1]), join)[0]
    assert links > 100
    assert sum(map(len, lists.values())) < 0.3 * total.sum()


def test_rows_grow_in_proportion_where_no_two_are_linked(spark, monkeypatch):
    """A hot group that shares a long passage: its prefixes meet in no list."""
    made = {}

    def counted(df, label):
        saved = plain(df, label)
        made.setdefault(label, []).append(saved.count())
        return saved

    plain = neardup.save
    monkeypatch.setattr(neardup, "save", counted)
    for n in (300, 600):
        rng = random.Random(9)
        passage = [f"p{i}" for i in range(104)]
        rows = [(i, " ".join(passage + [f"x{rng.randrange(10**9)}" for _ in range(20)])) for i in range(n)]
        made.clear()
        got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), join=Join(words=4, leaf=12, block=64, depth=4))
        assert got.where("kept").count() == n
        sizes = {label: sum(counts) for label, counts in made.items()}
        if n == 300:
            before = sizes
    assert sizes["near-prefixes"] > 0 and sizes["near-long-members"] == 0 and sizes["near-prefix-pairs"] == 0
    assert all(sizes[label] <= 3 * before.get(label, 0) + 100 for label in sizes if label not in ("near-open", "near-tried", "near-best"))


def test_small_tables_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, join=Join(words=4)).collect()}
    assert got == brute_force(rows, 4)


@pytest.mark.parametrize("seed", [1, 2])
def test_connected_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(80)]
    name = lambda n: bytes([n * 97 % 251, n // 251, n % 251])
    df = spark.createDataFrame([(name(a), name(b)) for a, b in links], "a binary, b binary")
    got = defaultdict(set)
    for r in connected_components(df).collect():
        got[bytes(r.component)].add(bytes(r.node))
    nodes = {n for link in links if link[0] != link[1] for n in link}
    want = defaultdict(set)
    for n, c in components(nodes, [x for x in links if x[0] != x[1]]).items():
        want[c].add(name(n))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert all(c in members for c, members in got.items())


def entropy(weights):
    return -sum(w * math.log(w) for w in weights if w) / math.log(len(weights))


def bisected(tokens, target):
    total = sum(tokens.values())
    shares = [n / total for n in tokens.values()]

    def weights(a):
        raw = [p**a for p in shares]
        return [r / sum(raw) for r in raw]

    def repeats(a):
        ratio = [w / p for w, p in zip(weights(a), shares)]
        return max(ratio) * target.budget / total if target.budget else max(ratio) / min(ratio)

    def edge(good, rising):
        if good(0.0 if rising else 1.0):
            return 0.0 if rising else 1.0
        if not good(1.0 if rising else 0.0):
            return 1.0 if rising else 0.0
        low, high = 0.0, 1.0
        for _ in range(80):
            mid = (low + high) / 2
            if good(mid) == rising:
                high = mid
            else:
                low = mid
        return high if rising else low

    a = edge(lambda a: entropy(weights(a)) >= target.entropy, False)
    return max(a, edge(lambda a: repeats(a) <= target.repeats, True))


def corpus(spark, sizes, seed=4):
    rng = random.Random(seed)
    rows = [
        (i, "w " * rng.randrange(0, 60), name)
        for i, name in enumerate(n for n, count in sizes.items() for _ in range(count))
    ]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


@pytest.mark.parametrize(
    "target",
    [
        Target(entropy=0.95, block=2000),
        Target(entropy=1.0, repeats=2.0, block=500),
        Target(entropy=0.9, budget=9000, block=1000),
        Target(entropy=1.0, repeats=3.0, budget=60000),
        Target(entropy=0.1),
    ],
)
def test_mix(spark, target):
    rows, docs = corpus(spark, {"hot": 900, "b": 200, "c": 100, None: 30})
    size = {i: len(text.split()) + 1 for i, text, _ in rows}
    of = {i: name or "" for i, _, name in rows}
    tokens = Counter()
    for i, n in size.items():
        tokens[of[i]] += n
    mix = plan_mix(docs, target)
    assert abs(mix.exponent - bisected(tokens, target)) < 1e-5
    found = mix_order(mix, target).collect()
    plan = {r.source: r for r in mix.sources.collect()}
    quota = {s: 0 for s in tokens}
    times = Counter()
    for r in found:
        assert r.source == of[r.id] and r.n_tokens == size[r.id]
        quota[r.source] += r.n_tokens
        times[r.id] += 1
    for s, n in quota.items():
        # A quota is met by the row that reaches it.
        assert plan[s].quota <= n < plan[s].quota + 61
        showings = {times[i] for i in size if of[i] == s}
        assert max(showings) - min(showings) <= 1
    if not target.budget:
        assert set(times) == set(size)
    # Places are gapless in each block, and blocks carry the weights of the whole.
    blocks = defaultdict(list)
    for r in found:
        blocks[r.block].append(r)
    for b in blocks.values():
        assert sorted(r.place for r in b) == list(range(len(b)))
    tokens_of = [sum(r.n_tokens for r in b) for b in blocks.values()]
    assert len(blocks) == max(1, -(-mix.budget // target.block)) and max(tokens_of) < 1.4 * mix.budget / len(blocks) + 61 * 4
    assert Counter(r.doc_id for r in mixed_rows(docs, target).collect()) == times


def test_mix_order_does_not_depend_on_partitions(spark):
    _, docs = corpus(spark, {"a": 50, "b": 20})
    first, second = mix_sources(docs.repartition(1)), mix_sources(docs.repartition(9))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))


def test_mix_of_odd_tables(spark):
    schema = "doc_id long, text string, source string, mix_key int, epochs int"
    assert mix_sources(spark.createDataFrame([], schema)).count() == 0
    assert mixed_rows(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, None, None, 1, 2), (1, "", "a", 3, 4), (1, "", "a", 3, 4), (2, "x " * 90_000, "a", 5, 6)]
    docs = spark.createDataFrame(rows, schema)
    mixed = mixed_rows(docs, Target(entropy=0.0))
    assert mixed.columns == docs.columns
    assert sorted(map(str, mixed.collect())) == sorted(map(str, docs.collect()))
    alone = docs.where("source = 'a'")
    assert mix_sources(alone).count() == 3


def test_blocks_of_mixed_rows(spark):
    """Copies lie in different blocks, and every block has the weights of the whole."""
    _, docs = corpus(spark, {"hot": 3000, "b": 400, "c": 60, None: 9})
    target = Target(entropy=0.98, repeats=6.0, block=500)
    mixed = mixed_rows(docs.withColumn("mix_key", F.lit("x")), target)
    placed = in_blocks(mixed, "part", target)
    assert placed.columns == [*mixed.columns, "part"] and placed.count() == mixed.count()
    found = placed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("part").alias("parts")).collect()
    assert all(r.n == r.parts for r in found) and max(r.n for r in found) > 2
    weights = defaultdict(Counter)
    for r in placed.groupBy("source", "part").count().collect():
        weights[r.source][r.part] = r["count"]
    blocks = 1 + max(p for c in weights.values() for p in c)
    assert blocks > 10
    for source, counts in weights.items():
        total = sum(counts.values())
        if total > 20 * blocks:
            assert all(0.4 * total / blocks < counts[p] < 1.8 * total / blocks for p in range(blocks)), source
    assert in_blocks(mixed.limit(0), "part").count() == 0


def test_packed_copies_of_a_mix_are_apart(spark):
    _, docs = corpus(spark, {"hot": 1500, "rare": 30})
    mixed = mixed_rows(docs, Target(entropy=0.95, repeats=8.0))
    assert mixed.count() > docs.count() + 30
    pieces = pack(in_blocks(mixed, "part"), tokenizer_path("word_bpe_49k.json"), size=64, parts=4, block="part").collect()
    places = defaultdict(list)
    order = sorted({(r.sequence_id, r.offset, r.id) for r in pieces if r.start == 0})
    for at, (_, _, id_) in enumerate(order):
        places[id_].append(at)
    repeated = [p for p in places.values() if len(p) > 1]
    assert repeated and all(b - a > 5 for p in repeated for a, b in zip(p, p[1:]))
