"""The registered queries of the operators, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm import (
    byte_bpe,
    conversation_trie,
    exact_dedup,
    fill_in_middle,
    language_id,
    licenses,
    packing,
    quality,
    quality_rules,
    secret_scan,
    simhash,
    substring_dedup,
    winnowing,
)
from ticketmill.llm.common import read_table, text_crc, written
from ticketmill.llm.oracle import CONVERSATION_TRIE_SQL, FILL_IN_MIDDLE_SQL, QUALITY_RULES_SQL

Query = Callable[[SparkSession, str], DataFrame]

SEQUENCE_LENGTH = 2048
SHINGLE_WORDS = 3
FINGERPRINT_BITS = 2
WINDOW_WORDS = 35
GOOD_SCORE = 0.3
# Conversations come in families of this size; a member takes fewer than so many opening turns from the first.
FAMILY_SIZE = 100
OPENING_TURNS = 6


def held_out(docs: DataFrame, parts: int, part: int):
    """True for rows kept from learning; rows without an id are among them."""
    return F.coalesce(text_crc(docs["doc_id"]) % parts == part, F.lit(True))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    kept_out = held_out(docs, 4, 2)
    model = language_id.train(docs.where(~kept_out), "doc_id", "text", "lang")
    return language_id.classify(docs, model, "doc_id", "text", {"held_out": kept_out})


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE_LENGTH)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), SHINGLE_WORDS, FINGERPRINT_BITS)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), WINDOW_WORDS)


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprint_chain(read_table(spark, sf_dir, "documents"))


def quality_model(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, quality.QualityModel]:
    """The statistics of ``docs``, and the classifier learned from their labels that aren't held out."""
    described = written(quality.describe(docs), "statistics")
    learned = labels.where(~held_out(labels, 5, 0))
    return described, quality.train(described, learned, "doc_id", "quality")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, held_out, score, predicted; learned from labels that aren't held out."""
    described, model = quality_model(docs, labels)
    scored = quality.score(described, model)
    return scored.select(
        "doc_id",
        "text_hash",
        held_out(scored, 5, 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= GOOD_SCORE, 1).otherwise(0).cast("int").alias("predicted"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scores.drop("text_hash")


def labelled_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settled findings in the addresses of ``pages``."""
    pages = secret_scan.find_candidates(read_table(spark, sf_dir, "pages"), "page_id", "url")
    return secret_scan.labelled_findings(pages)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(
        read_table(spark, sf_dir, "documents"), labelled_extra=labelled_addresses(spark, sf_dir)
    ).drop("text_hash")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.bpe_digests(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = fill_in_middle.restore(fill_in_middle.transform(read_table(spark, sf_dir, "documents")))
    return filled.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    conv_id = F.col("conv_id")
    sequences = written(conversation_trie.turn_sequences(conversations), "conversations")
    rebuilt = conversation_trie.graft_openings(
        sequences, conv_id - conv_id % FAMILY_SIZE, text_crc(conv_id) % OPENING_TURNS, OPENING_TURNS - 1
    )
    return conversation_trie.prefix_trie(rebuilt)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def queries() -> dict[str, Query]:
    operators = (
        op1_language_id,
        op2_best_fit_packing,
        op3_exact_dedup,
        op4_simhash,
        op5_license_scan,
        op6_substring_dedup,
        op7_winnowing,
        op8_quality,
        op9_secret_scan,
        op10_byte_bpe,
        op11_fill_in_middle,
        op12_conversation_trie,
        op13_quality_rules,
    )
    return {operator.__name__: operator for operator in operators}


EXACT_DEDUP_SQL = r"""
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), grouped AS (
  SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) AS nth
  FROM digests
)
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, text_sha256 FROM grouped
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": EXACT_DEDUP_SQL,
        "op11_fill_in_middle": FILL_IN_MIDDLE_SQL,
        "op12_conversation_trie": CONVERSATION_TRIE_SQL,
        "op13_quality_rules": QUALITY_RULES_SQL,
    }
