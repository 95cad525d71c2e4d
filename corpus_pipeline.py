"""A pipeline over ``documents``: quality, exact copies, near copies, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but
the last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ticketmill.llm import exact_dedup, packing, quality, queries, secret_scan, simhash
from ticketmill.llm.common import read_table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from the labels of these documents.

    Each row is judged by its own text, whatever its id; see ``quality.keep_scored``.
    """
    _, model = queries.quality_model(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_scored(docs, model, queries.GOOD_SCORE)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, that with the smallest id; null counts as empty, null ids come last."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies stays; see ``simhash.drop_near_duplicates``."""
    return simhash.drop_near_duplicates(docs, queries.SHINGLE_WORDS, queries.FINGERPRINT_BITS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The detector of op9_secret_scan: it also learns from the addresses of ``pages``."""
    addresses = queries.labelled_addresses(spark, sf_dir)
    return secret_scan.redact_secrets(docs, length_col="n_chars", labelled_extra=addresses)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row, null texts as empty ones, in sequences; an empty table gives none."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), queries.SEQUENCE_LENGTH)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack),
]

# Fingerprints, the classifiers and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
