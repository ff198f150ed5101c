"""Training corpus from the documents table, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; its result is written as a table and read again as the next
one's documents.  All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelworks.llm import language_id
from funnelworks.llm.decontamination import drop_contaminated
from funnelworks.llm.exact_dedup import drop_exact_copies
from funnelworks.llm.near_dedup import drop_near_copies
from funnelworks.llm.packing import pack
from funnelworks.llm.prepare import prepared
from funnelworks.llm.queries import WORDS, fold
from funnelworks.llm.storage import read_table, stored


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    prepared(spark)
    model = language_id.fit(docs, fold(F.col("doc_id"), 3) != 1)
    return language_id.keep_identified(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document a distinct text."""
    return drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document a group: five-word shingles, similarity of 0.8 or more."""
    prepared(spark)
    return drop_near_copies(docs, shingle=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepared(spark)
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    prepared(spark)
    pieces = pack(docs, public_tokenizers.path(WORDS), capacity=2048, end=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", identified),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Language models and tokenizers are beyond SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
