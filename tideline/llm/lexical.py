"""Ranked lexical search over an index in strata of equal length."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.common import raw_bytes, save, slices, text_of

# Bytes of terms: digits, letters and all of every character beyond ASCII. A-Z become lower case,
# the rest becomes white space.
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, repeats included."""
    return text.translate(_BYTES).split()


@dataclass(frozen=True)
class Search:
    """``k`` documents are returned for an item.

    A stratum is dealt by hash into units of about ``unit`` documents. Items are taken in blocks of
    about ``block`` (item, term) rows, each with a vocabulary that tasks hold whole. Each item first visits the
    ``seeds`` units with the highest bounds, then all others whose bound reaches its threshold.
    """

    k: int = 50
    unit: int = 4096
    block: int = 1 << 18
    seeds: int = 4


class Questions:
    """A block of items as arrays over a vocabulary: what tasks get by broadcast."""

    def __init__(self, rows: list[tuple]):
        self.vocabulary = {t: i for i, t in enumerate(sorted({bytes(term) for _, term in rows}))}
        self.ids = sorted({item for item, _ in rows})
        number = {item: i for i, item in enumerate(self.ids)}
        asked = sorted((number[item], self.vocabulary[bytes(term)]) for item, term in rows)
        self.item, self.term = (np.array(c, np.int64) for c in zip(*asked))
        self.first = np.searchsorted(self.item, np.arange(len(self.ids) + 1))
        self.weight = np.zeros(len(self.vocabulary), np.int64)
        # The same rows by term, for the bounds.
        order = np.argsort(self.term, kind="stable")
        self.items_by_term = self.item[order]
        self.first_of_term = np.searchsorted(self.term[order], np.arange(len(self.vocabulary) + 1))

    def terms(self, item: int) -> np.ndarray:
        return self.term[self.first[item] : self.first[item + 1]]

    def bounds(self, terms: np.ndarray, impacts: np.ndarray) -> np.ndarray:
        """For each item the sum of its terms' weights times the impacts given for them."""
        starts, counts = self.first_of_term[terms], np.diff(self.first_of_term)[terms]
        # Positions of all items of each term, one term after the other.
        at = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        bound = np.zeros(len(self.ids), np.int64)
        np.add.at(bound, self.items_by_term[at], np.repeat(self.weight[terms] * impacts, counts))
        return bound


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    """What ``tf`` occurrences of a term count for in a document of normaliser ``m``."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def weight(df: int, n: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, term): each term of an item once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [set(terms_of(t)) for t in raw_bytes(batch.column(1))]
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(found)), list(map(len, found)))))
            yield pa.RecordBatch.from_arrays([ids, pa.array([t for s in found for t in s], pa.binary())], names=["item", "term"])

    rows = items.select(F.col(f"`{item}`").alias("item"), text_of(text).alias("text")).where("item is not null")
    return rows.mapInArrow(work, f"item {items.schema[item].dataType.simpleString()}, term binary").distinct()


def _matched(docs: DataFrame, shared) -> DataFrame:
    """(id, n, terms, tfs) of every document: its number of terms, and the vocabulary's terms in it
    with their occurrences."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value.vocabulary
        for batch in slices(batches):
            n, terms, tfs = [], [], []
            for text in raw_bytes(batch.column(1)):
                found = terms_of(text)
                n.append(len(found))
                known = [(vocabulary[t], tf) for t, tf in Counter(found).items() if t in vocabulary]
                terms.append(np.array([t for t, _ in known], np.int32).tobytes())
                tfs.append(np.array([tf for _, tf in known], np.int32).tobytes())
            made = [pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["id", "n", "terms", "tfs"])

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(work, f"id {id_type}, n bigint, terms binary, tfs binary")


def _document_counts(matched: DataFrame) -> list[tuple[int, int]]:
    """(term, documents that hold it), for terms of the vocabulary."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            terms, df = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(df, pa.int64())], names=["term", "df"])

    counts = matched.select("terms").mapInArrow(work, "term int, df bigint")
    return [tuple(r) for r in counts.groupBy("term").agg(F.sum("df")).collect()]


_UNIT = [("m", pa.int64(), "bigint"), ("part", pa.int64(), "bigint")]
_LISTS = ("run_term", "run_tf", "run_size", "members", "top_term", "top_tf")


def _packed_unit(docs: list[tuple]) -> list[bytes]:
    """The lists of a unit: postings by term and tf in runs, members (positions of documents) of each
    run, and each term's largest tf."""
    terms = np.concatenate([np.frombuffer(t, np.int32) for _, t, _ in docs])
    tfs = np.concatenate([np.frombuffer(t, np.int32) for _, _, t in docs])
    members = np.repeat(np.arange(len(docs), dtype=np.int32), [len(t) // 4 for _, t, _ in docs])
    order = np.lexsort((members, tfs, terms))
    terms, tfs, members = terms[order], tfs[order], members[order]
    new = np.flatnonzero(np.diff(terms, prepend=-1).astype(bool) | np.diff(tfs, prepend=-1).astype(bool))
    size = np.diff(new, append=len(terms)).astype(np.int32)
    last = np.flatnonzero(np.diff(terms[new], append=-1))
    lists = [terms[new], tfs[new], size, members, terms[new][last], tfs[new][last]]
    return [x.astype(np.int32).tobytes() for x in lists]


def _index(matched: DataFrame, n: int, total: int, search: Search) -> DataFrame:
    """The index: a row for each unit of a stratum, with its documents' ids and its lists.

    Documents of one normaliser are a stratum; all lengths may be equal, so a stratum is dealt by
    row into as many units as it needs. Documents without an id or without a term of the vocabulary
    cannot be found and are left out.
    """
    id_type = matched.schema["id"].dataType
    m = F.expr(f"50 + (cast(50 as decimal(38, 0)) * n * {n}) div {max(total, 1)}")
    rows = matched.where(F.col("id").isNotNull() & (F.length("terms") > 0)).withColumn("m", m)
    sizes = rows.groupBy("m").agg(F.ceil(F.count(F.lit(1)) / search.unit).cast("bigint").alias("parts"))
    rows = rows.join(save(sizes, "lexical-strata"), "m")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, docs, kind = None, [], None

        def made() -> pa.RecordBatch:
            columns = [pa.array([v], t) for v, (_, t, _) in zip(unit, _UNIT)]
            columns.append(pa.array([[d[0] for d in docs]], pa.list_(kind)))
            columns += [pa.array([x], pa.binary()) for x in _packed_unit(docs)]
            return pa.RecordBatch.from_arrays(columns, names=[*(name for name, _, _ in _UNIT), "ids", *_LISTS])

        for batch in slices(batches, 4096):
            kind = batch.schema.field(2).type
            for *of, id_, terms, tfs in zip(*(c.to_pylist() for c in batch.columns)):
                if of != unit:
                    if docs:
                        yield made()
                    unit, docs = of, []
                docs.append((id_, terms, tfs))
        if docs:
            yield made()

    dealt = rows.select("m", "part", "id", "terms", "tfs").repartition("m", "part").sortWithinPartitions("m", "part")
    schema = ", ".join([*(f"{name} {sql}" for name, _, sql in _UNIT), f"ids array<{id_type.simpleString()}>", *(f"{x} binary" for x in _LISTS)])
    return save(dealt.mapInArrow(work, schema), "lexical-index")


def _bounds(index: DataFrame, shared) -> DataFrame:
    """(item, m, part, bound): the most that a document of the unit can score for the item, where
    that is more than nothing."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions = shared.value
        for batch in slices(batches, 64):
            for m, part, terms, tfs in zip(*(c.to_pylist() for c in batch.columns)):
                bound = questions.bounds(np.frombuffer(terms, np.int32), impact(np.frombuffer(tfs, np.int32).astype(np.int64), m))
                items = np.flatnonzero(bound)
                same = [pa.array(np.full(len(items), v, np.int64)) for v in (m, part)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, pa.int64()), *same, pa.array(bound[items])], names=["item", "m", "part", "bound"]
                )

    lists = index.select("m", "part", "top_term", "top_tf")
    return lists.mapInArrow(work, "item bigint, m bigint, part bigint, bound bigint")


class _Unit:
    """A unit's postings, with the impact of each run."""

    def __init__(self, m: int, ids: list, run_term: bytes, run_tf: bytes, run_size: bytes, members: bytes):
        terms, tfs, size, self.members = (np.frombuffer(x, np.int32) for x in (run_term, run_tf, run_size, members))
        self.ids = ids
        self.impacts = np.repeat(impact(tfs.astype(np.int64), m), size)
        self.terms, first = np.unique(terms, return_index=True)
        ends = np.concatenate([[0], np.cumsum(size)])
        self.starts = np.append(ends[first], len(self.members))

    def best(self, terms: np.ndarray, weights: np.ndarray, least: int, k: int) -> list[tuple]:
        """(id, score) of the k highest scores of ``least`` or more, equal ones by id."""
        score = np.zeros(len(self.ids), np.int64)
        at = np.searchsorted(self.terms, terms)
        here = np.flatnonzero(self.terms[np.minimum(at, len(self.terms) - 1)] == terms)
        for i in here:
            run = slice(self.starts[at[i]], self.starts[at[i] + 1])
            score[self.members[run]] += weights[i] * self.impacts[run]  # a document once a term
        hits = np.flatnonzero(score >= least)
        if len(hits) > k:
            hits = hits[score[hits] >= np.partition(score[hits], -k)[-k]]
        return sorted(((self.ids[i], int(score[i])) for i in hits), key=lambda r: (-r[1], r[0]))[:k]


def _visits(index: DataFrame, item_type: str, shared, seeds, thresholds, search: Search) -> DataFrame:
    """(item_id, item, id, score): the best of each visited unit for the items that visit it.

    Without thresholds these are its seeds, else all items whose bound reaches their threshold,
    without its seeds. A task raises an item's threshold to the k-th score of its own visits so far, so what
    it returns hardly grows with the number of its units.
    """
    id_type = index.schema["ids"].dataType.elementType.simpleString()
    item_kind = pa.string() if item_type == "string" else pa.int64()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions, first = shared.value, seeds.value
        least = np.ones(len(questions.ids), np.int64) if thresholds is None else thresholds.value.copy()
        highest: dict[int, list[int]] = {}
        for batch in slices(batches, 16):
            id_kind = batch.schema.field("ids").type.value_type
            for m, part, ids, *lists, top_term, top_tf in zip(*(c.to_pylist() for c in batch.columns)):
                seeded = first.get((m, part), ())
                items = seeded
                if thresholds is not None:
                    tops = np.frombuffer(top_tf, np.int32).astype(np.int64)
                    bound = questions.bounds(np.frombuffer(top_term, np.int32), impact(tops, m))
                    items = np.setdiff1d(np.flatnonzero(bound >= least), seeded)
                if not len(items):
                    continue
                unit, found = _Unit(m, ids, *lists), []
                for item in items:
                    terms = questions.terms(item)
                    best = unit.best(terms, questions.weight[terms], int(least[item]), search.k)
                    found += [(questions.ids[item], int(item), id_, score) for id_, score in best]
                    scores = highest[item] = sorted(highest.get(item, []) + [s for _, s in best])[-search.k :]
                    if len(scores) == search.k:
                        least[item] = max(least[item], scores[0])
                columns = list(zip(*found)) or [()] * 4
                types = (item_kind, pa.int64(), id_kind, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names=["item_id", "item", "id", "score"]
                )

    names = ["m", "part", "ids", *_LISTS]
    return index.select(*names).mapInArrow(work, f"item_id {item_type}, item bigint, id {id_type}, score bigint")


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item, with their ranks."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _ranked(spark: SparkSession, docs: DataFrame, rows: list[tuple], item_type: str, search: Search) -> DataFrame:
    """The answers to one block of items."""
    questions, context = Questions(rows), spark.sparkContext
    matched = _matched(docs, context.broadcast(questions))
    matched = save(matched.withColumn("row", F.monotonically_increasing_id()), "lexical-matched")
    n, total = matched.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    for term, df in _document_counts(matched):
        questions.weight[term] = weight(df, n)
    shared = context.broadcast(questions)
    index = _index(matched, n, total, search)
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "m", "part")
    ranked = _bounds(index, shared).withColumn("place", F.row_number().over(order))
    first: dict[tuple, list[int]] = {}
    for r in ranked.where(F.col("place") <= search.seeds).select("item", "m", "part").collect():
        first.setdefault((r.m, r.part), []).append(r.item)
    seeds = context.broadcast({unit: np.array(sorted(items)) for unit, items in first.items()})
    visited = save(_visits(index, item_type, shared, seeds, None, search), "lexical-seeds")
    thresholds = np.ones(len(questions.ids), np.int64)
    for r in _top(visited, search.k).where(F.col("rank") == search.k).select("item", "score").collect():
        thresholds[r.item] = r.score
    rest = _visits(index, item_type, shared, seeds, context.broadcast(thresholds), search)
    return _top(visited.unionByName(save(rest, "lexical-rest")), search.k)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    search: Search = Search(),
) -> DataFrame:
    """(item_id, rank, id, score): for each item the ``k`` documents with the highest scores above zero.

    Terms are runs of ASCII letters and digits and of any characters beyond ASCII, A-Z lower-cased.
    A term's weight is floor(1000 ln((2N + 2) / (2df + 1))), a document's normaliser m is
    50 + (50 n N) div L, and its score the sum over the item's terms, once each, of the weight times
    (10**9 tf) div (1000 tf + 20 m): n and L count terms of the document and of all, N the documents
    with terms. Counts are over all documents. Equal scores are ranked by id.

    The index groups documents by m; within a unit of such a stratum, postings are grouped by tf, so
    that an impact is computed once per term and tf. With each term's largest tf, a unit has a bound on its scores for
    an item. Units with the highest bounds are visited first; the k-th score found there is the threshold, and a
    unit whose bound is below it is not visited. Nothing else is left out, so the answer is exact.

    The index holds terms that items of the block ask for. Items come in blocks of about ``block`` terms in
    all: what tasks and the driver hold of them is bounded by that (or by one item's text). Items should have integer
    or string ids; rows that repeat an item's id are one item with the terms of all; items without an id or without terms get no
    rows. Null texts have no terms. Documents without an id count in N, L and df, but are not
    returned; rows that repeat an id are documents of their own. Whole texts are read, however long.
    Without documents or items the answer is empty. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), text_of(text).alias("text"))
    item_type = "bigint" if items.schema[item_column].dataType.simpleString() != "string" else "string"
    asked = items.withColumn(item_column, F.col(f"`{item_column}`").cast(item_type))
    asked = save(_item_terms(asked, item_column, item_text), "lexical-items")
    blocks = -(-asked.count() // search.block)
    found = []
    for block in range(blocks):
        own = [tuple(r) for r in asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()]
        if own:
            found.append(_ranked(spark, rows, own, item_type, search))
    if not found:
        id_type = rows.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {item_type}, rank int, id {id_type}, score bigint")
    return reduce(DataFrame.unionByName, found).select("item_id", F.col("rank").cast("int").alias("rank"), "id", "score")
