"""The digest index and the URL rules, by hand-made rows and against plain Python."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tideline.llm.exact import DigestIndex
from tideline.llm.urls import BlockedBloomFilter, url_verdicts
from tideline.session import scratch_path

DOCS = "doc_id long, text string"


def verdicts(index, rows, spark):
    found = index.add(spark.createDataFrame(rows, DOCS)).collect()
    return sorted(((r.id is not None, r.id, r.keep_id, r.group_size, r.kept) for r in found), key=str)


def test_largest_id_stays_and_null_is_empty(spark):
    index = DigestIndex(spark, scratch_path(spark, "index"), 3)
    rows = [(1, "a"), (5, "a"), (3, "a"), (4, None), (2, ""), (6, "A")]
    assert verdicts(index, rows, spark) == [
        (True, 1, 5, 3, False), (True, 2, 4, 2, False), (True, 3, 5, 3, False),
        (True, 4, 4, 2, True), (True, 5, 5, 3, True), (True, 6, 6, 1, True),
    ]
    hashes = {bytes(r.digest).hex() for r in index.table().collect()}
    assert hashes == {hashlib.sha256(t.encode()).hexdigest() for t in ("a", "", "A")}


def test_index_persists_and_is_bucketed(spark):
    path = scratch_path(spark, "index")
    verdicts(DigestIndex(spark, path, 4), [(1, "old"), (2, "both")], spark)
    spark.sql(f"DROP TABLE {DigestIndex(spark, path, 4).name}")  # the files stay
    again = DigestIndex(spark, path, 4)
    assert verdicts(again, [(9, "both"), (8, "new"), (7, "new")], spark) == [
        (True, 7, 8, 2, False), (True, 8, 8, 2, True), (True, 9, 2, 1, False),
    ]
    assert again.table().count() == 3
    # The same batch again changes nothing.
    assert verdicts(again, [(9, "both"), (8, "new"), (7, "new")], spark)[1] == (True, 8, 8, 2, True)
    assert again.table().count() == 3
    plan = again.table().groupBy("digest").count()._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("== Physical Plan ==")[1]


def test_buckets_are_those_of_the_folder(spark):
    path, before = scratch_path(spark, "index"), spark.conf.get("spark.sql.shuffle.partitions")
    rows = [(i, f"text {i}") for i in range(200)]
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        verdicts(DigestIndex(spark, path), rows, spark)
        spark.conf.set("spark.sql.shuffle.partitions", 5)
        again = DigestIndex(spark, path)
        assert again.buckets == 8
        assert all(keep == i and kept for _, i, keep, _, kept in verdicts(again, rows, spark))
        assert again.table().count() == again.spark.table(again.name).count() == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    with pytest.raises(ValueError, match="has 8 buckets"):
        DigestIndex(spark, path, 5)


def test_compaction_leaves_a_file_for_each_bucket(spark):
    path = scratch_path(spark, "index")
    index = DigestIndex(spark, path, 3)
    for i in range(3):
        verdicts(index, [(100 * i + j, f"text {j % (20 + 10 * i)}") for j in range(60)], spark)
    want = sorted((bytes(r.digest), r.keep_id) for r in index.table().collect())
    # As if two writers had added the same new text at once.
    index.table().limit(1).withColumn("keep_id", F.lit(-5).cast("bigint")).write.insertInto(index.name)
    stale = DigestIndex(spark, path)
    index.compact()
    assert len(spark.table(index.name).inputFiles()) == 3
    for opened in (index, DigestIndex(spark, path), stale):
        assert sorted((bytes(r.digest), r.keep_id) for r in opened.table().collect()) == want
    assert [kept for *_, kept in verdicts(DigestIndex(spark, path), [(9, "text 3"), (8, "fresh")], spark)] == [True, False]


def test_null_ids_repeats_and_empty_batches(spark):
    index = DigestIndex(spark, scratch_path(spark, "index"), 2)
    assert verdicts(index, [], spark) == []
    rows = [(None, "x"), (1, "x"), (1, "x"), (None, "y"), (None, "y")]
    assert verdicts(index, rows, spark) == [
        (False, None, 1, 3, False), (False, None, None, 2, True), (False, None, None, 2, True),
        (True, 1, 1, 3, True), (True, 1, 1, 3, True),
    ]


def test_keep_new_keeps_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a", "x"), (2, "a", "y"), (3, "b", None)], "doc_id long, text string, bloom_block string"
    )
    kept = DigestIndex(spark, scratch_path(spark, "index"), 2).keep_new(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(2, "a", "y"), (3, "b", None)]


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de", "block")]


def expected(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [
        (len(h + p), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("rules", [RULES, [], RULES + [("a.b.c.d", "", "block"), ("", "/x", "block"), (None, "/", "block")]])
def test_url_rules(spark, rules):
    urls = [
        None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://X.NET/a?b=/c", "http://a.example.net/en/x",
        "http://a.example.net/en", "http://notexample.com/de", "https://www.EXAMPLE.com/default#x", "http://example.com/en/?/de",
        "http://x.a.b.c.d", "http://a.b.c.d/", "x://y://net/", "http://é.net/ü?", "http://..net/", "http://net:80/", "http://u@net/",
        "http://net/\nb", "http://" + "a." * 300 + "net/" + "p" * 5000,
    ]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(1, urls[6])], "page_id long, url string")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_verdicts(pages, listed).collect() if r.page_id != 1}
    usable = [(h, p, v) for h, p, v in rules if h]
    assert got == {i: expected(u, usable) for i, u in enumerate(urls) if i != 1}
    assert url_verdicts(pages, listed).count() == len(urls) + 1


def test_url_clashing_columns_and_empty_table(spark):
    listed = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([("http://b.net/", "x", 1)], "url string, host string, rule_path int")
    row = url_verdicts(pages, listed).first()
    assert (row.host, row.rule, row.rule_path) == ("b.net", "net/", 1)
    assert url_verdicts(pages.limit(0), listed).count() == 0


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    bloom = BlockedBloomFilter(keys, "key")
    assert bloom.possible(keys, "key").count() == 3000
    others = spark.range(20000).select(F.concat(F.lit("z"), "id").alias("key"))
    assert bloom.possible(others, "key").count() < 200
