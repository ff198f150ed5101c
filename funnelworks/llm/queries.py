"""The registered queries: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelworks.llm import language_id, toxicity
from funnelworks.llm.alignment import alignment_scores
from funnelworks.llm.decontamination import contained_items
from funnelworks.llm.exact_dedup import exact_groups
from funnelworks.llm.id_files import read_ids, write_ids
from funnelworks.llm.line_dedup import dedup_lines
from funnelworks.llm.near_dedup import near_duplicates
from funnelworks.llm.packing import pack
from funnelworks.llm.prepare import prepared
from funnelworks.llm.storage import read_table
from funnelworks.llm.token_counts import token_counts
from funnelworks.llm.url_rules import Rule, judge_urls
from funnelworks.llm.warc import archive_pages
from funnelworks.llm.whitening import whiten

WORDS, BYTES, PIECES = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"
URL_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def op1_rans_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    written = write_ids(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS), end=1)
    return read_ids(spark, written).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    found = archive_pages(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTES), limit=1024)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The learnt language of highest score wherever the text has a letter;
    ``rejected`` marks texts below a calibrated bound of score or familiarity."""
    prepared(spark)
    docs = read_table(spark, sf_dir, "documents")
    own = fold(F.col("doc_id"), 3)
    model = language_id.fit(docs, own != 1)
    found = language_id.identify(docs, model)
    return found.select("doc_id", F.coalesce(own == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return exact_groups(read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, fold(F.col("doc_id"), 5) != 0)
    return toxicity.tag_toxic(docs, model).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "spans",
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    pieces = pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS), capacity=2048, end=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    found = whiten(read_table(spark, sf_dir, "embeddings"), limit=32)
    return found.withColumn("deviation", F.col("deviation").cast("long"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    found = dedup_lines(read_table(spark, sf_dir, "documents"), min_chars=20, min_docs=3)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return alignment_scores(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTES), public_tokenizers.path(PIECES))


QUERIES = {
    f.__name__: f
    for f in (
        op1_rans_ids, op2_warc_members, op3_token_counts, op4_language_id, op5_url_rules,
        op6_exact_dedup, op7_toxicity, op8_near_dedup, op9_packing, op10_decontamination,
        op11_whitening, op12_line_dedup, op13_alignment,
    )
}
