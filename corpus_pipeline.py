"""A corpus from raw documents to packed sequences, stage by stage.

``STAGES`` lists (name, function) in order; each function takes the session, the rows that the stage
before it kept and the data folder. ``run`` writes what a stage returns as Parquet below the shared
folder and reads it back for the next one. All stages but the last return the columns of documents.

An empty table goes through every stage; null texts count as empty. Columns that the operators make
for themselves never clash with those of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import fresh, save, ship
from tideline.llm.exact import DigestIndex
from tideline.llm.mixing import in_blocks, mixed_rows
from tideline.llm.neardup import without_near_duplicates
from tideline.llm.packing import pack
from tideline.llm.quality import accepted, classify
from tideline.llm.queries import table, tokenizer_path
from tideline.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    ship(spark)
    _, model = classify(docs, table(spark, sf_dir, "labels"))
    return accepted(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: that with the largest id."""
    ship(spark)
    return DigestIndex(spark, scratch_path(spark, "digest-index")).keep_new(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8): that with the smallest id."""
    ship(spark)
    return without_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, some sources repeated in part, so that the mix meets its entropy."""
    ship(spark)
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences, with the checksum of their ids. The mix's blocks follow each
    other, so that copies stay apart; along the curve are neighbours of one block."""
    ship(spark)
    blocks = fresh(docs, "block")
    pieces = pack(in_blocks(docs, blocks), tokenizer_path("word_bpe_49k.json"), block=blocks)
    pieces = pieces.withColumnRenamed("id", "doc_id")
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


STAGES = [
    ("quality", quality),
    ("exact", exact),
    ("near", near),
    ("mixing", mixing),
    ("packing", packing),
]

# SQL can express neither the classifier nor the similarity join: tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
