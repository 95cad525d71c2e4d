"""Quality classifier: regularised quadratic discriminant analysis (operator 8).

A text is described by statistics that are transformed to be closer to normal (logarithms
of counts, logits of shares). Each class has a mean and a covariance, shrunk towards the
pooled covariance and towards a diagonal. The score is the probability of class 1 from the
difference of the two log densities, each a Mahalanobis distance solved with the class's
Cholesky factor, which is computed once.

Training aggregates counts, sums and sums of products of all labelled rows; only these
totals, whose number depends on the number of statistics alone, reach the driver.

Defined results: a null text counts as empty; it has statistics and a score like any other.
Labels other than 0 and 1, and rows without an id, are ignored; a document labelled both
ways counts for both. Repeated equal labels count once. If only one class has labels, every
score is that class; without labels every score is 0.5. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import arrow_map, as_bytes, id_and_text, prepare_workers
from ticketmill.llm.named_rows import whole_row

# Shares of the pooled covariance and of the diagonal in a class's covariance.
POOLED_SHARE = 0.1
DIAGONAL_SHARE = 0.05
FLOOR = 1e-3

# Classes of bytes: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 punctuation of prose, 6 other symbols, 7 not ASCII.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[33:127] = 6
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[ord(one) for one in ".,;:'\"-()?"]] = 5
_CLASS[128:] = 7

# What prose usually has: shares, and the rest. A short text says little about itself, so
# each statistic starts from so many usual bytes, words or lines and is moved by the text's own.
USUAL_BYTES, USUAL_WORDS, USUAL_LINES = 60, 12, 3
USUAL = {
    "lower_share": 0.8,
    "upper_share": 0.02,
    "digit_share": 0.002,
    "prose_punctuation_share": 0.02,
    "symbol_share": 0.002,
    "other_bytes_share": 0.03,
    "distinct_words_share": 0.9,
    "short_words_share": 0.35,
    "repeated_lines_share": 0.01,
    "repeated_word_pairs_share": 0.02,
    "mean_word": 6.0,
    "spread_of_words": 3.5,
    "line_words": 12.0,
    "byte_entropy": 4.2,
}
STATISTICS = tuple(USUAL)


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of a whole text, in the order of ``STATISTICS``.

    Shares become logits; means and spreads become logarithms.
    """
    data = np.frombuffer(text, dtype=np.uint8)
    per_byte = np.bincount(data, minlength=256)
    kinds = np.bincount(_CLASS, weights=per_byte, minlength=8)
    size = len(data)
    words = text.split()
    count = len(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=count)
    lines = [line for line in text.split(b"\n") if line.strip()]
    pairs = max(0, count - 1)
    shares = per_byte[per_byte > 0] / max(1, size)

    def logit(name: str, part: float, whole: float, usual: int) -> float:
        part, whole = part + usual * USUAL[name], whole + usual
        return float(np.log(part / (whole - part)))

    def mean(name: str, own: float, weight: float, usual: int) -> float:
        return (own * weight + USUAL[name] * usual) / (weight + usual)

    return [
        logit("lower_share", kinds[1], size, USUAL_BYTES),
        logit("upper_share", kinds[2], size, USUAL_BYTES),
        logit("digit_share", kinds[3], size, USUAL_BYTES),
        logit("prose_punctuation_share", kinds[5], size, USUAL_BYTES),
        logit("symbol_share", kinds[6], size, USUAL_BYTES),
        logit("other_bytes_share", kinds[7], size, USUAL_BYTES),
        logit("distinct_words_share", len(set(words)), count, USUAL_WORDS),
        logit("short_words_share", int((lengths <= 3).sum()), count, USUAL_WORDS),
        logit("repeated_lines_share", len(lines) - len(set(lines)), len(lines), USUAL_LINES),
        logit("repeated_word_pairs_share", pairs - len(set(zip(words, words[1:]))), pairs, USUAL_WORDS),
        float(np.log(mean("mean_word", lengths.mean() if count else 0.0, count, USUAL_WORDS))),
        float(np.log(mean("spread_of_words", lengths.std() if count else 0.0, count, USUAL_WORDS))),
        float(np.log(mean("line_words", count / max(1, len(lines)), len(lines), USUAL_LINES))),
        mean("byte_entropy", float(-(shares * np.log2(shares)).sum()) if size else 0.0, size, USUAL_BYTES),
    ]


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash and its statistics as an array."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(text) for text in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(rows, pa.list_(pa.float64()))],
                names=["doc_id", "text_hash", "statistics"],
            )

    rows = id_and_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    return arrow_map(rows, compute, "doc_id long, text_hash long, statistics array<double>")


@dataclass(frozen=True)
class Gaussian:
    """A class: log prior, mean, Cholesky factor of its shrunk covariance and the log of its determinant."""

    log_prior: float
    mean: np.ndarray
    factor: np.ndarray
    log_determinant: float

    def log_density(self, rows: np.ndarray) -> np.ndarray:
        from numpy.linalg import solve

        distances = solve(self.factor, (rows - self.mean).T)
        return self.log_prior - 0.5 * (self.log_determinant + (distances**2).sum(axis=0))


@dataclass(frozen=True)
class QualityModel:
    classes: dict[int, Gaussian]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        if len(self.classes) < 2:
            return np.full(len(rows), float(*self.classes) if self.classes else 0.5)
        odds = self.classes[1].log_density(rows) - self.classes[0].log_density(rows)
        return 1.0 / (1.0 + np.exp(np.clip(-odds, -700, 700)))


def train(described: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> QualityModel:
    """Fits on the rows of ``described`` that have a label."""
    wanted = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .distinct()
    )
    width = len(STATISTICS)
    products = F.flatten(
        F.transform("statistics", lambda a: F.transform("statistics", lambda b: a * b))
    )
    totals = (
        described.join(wanted.hint("merge"), "doc_id")  # one way at every size
        .select("label", F.posexplode(F.concat(F.array(F.lit(1.0)), "statistics", products)).alias("at", "value"))
        .groupBy("label", "at")
        .agg(F.sum("value").alias("total"))
        .collect()  # two classes times (1 + width + width squared) numbers
    )
    sums = {label: np.zeros(1 + width + width * width) for label in {row["label"] for row in totals}}
    for row in totals:
        sums[row["label"]][row["at"]] = row["total"]
    return fit(sums)


def fit(sums: dict[int, np.ndarray]) -> QualityModel:
    """Classes from their counts, sums and sums of products."""
    width = len(STATISTICS)
    counts = {label: total[0] for label, total in sums.items()}
    means = {label: total[1 : width + 1] / total[0] for label, total in sums.items()}
    scatter = {
        label: total[width + 1 :].reshape(width, width) - counts[label] * np.outer(means[label], means[label])
        for label, total in sums.items()
    }
    every = sum(counts.values())
    pooled = sum(scatter.values(), np.zeros((width, width))) / max(1.0, every)
    classes = {}
    for label in sums:
        own = scatter[label] / counts[label]
        shrunk = (1 - POOLED_SHARE) * own + POOLED_SHARE * pooled
        shrunk = (1 - DIAGONAL_SHARE) * shrunk + DIAGONAL_SHARE * np.diag(np.diag(shrunk)) + FLOOR * np.eye(width)
        factor = np.linalg.cholesky(shrunk)
        classes[label] = Gaussian(
            float(np.log(counts[label] / every)), means[label], factor, 2 * float(np.log(np.diag(factor)).sum())
        )
    return QualityModel(classes)


def score(described: DataFrame, model: QualityModel) -> DataFrame:
    """Per row of ``described``: doc_id, text_hash and score."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column("statistics").to_pylist(), dtype=float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(model.scores(rows), pa.float64())],
                names=["doc_id", "text_hash", "score"],
            )

    return arrow_map(
        described.select("doc_id", "text_hash", "statistics"), apply, "doc_id long, text_hash long, score double"
    )


def keep_scored(docs: DataFrame, model: QualityModel, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has at least this score, with all their columns.

    Each row is scored and kept or not by itself: null and empty texts have a score like any
    other, rows that repeat a text go together, an empty table stays empty, and no column is
    added, so none can clash.
    """
    prepare_workers(docs.sparkSession)

    @F.arrow_udf("double")
    def score_of(texts: pa.Array) -> pa.Array:
        rows = np.array([statistics(text) for text in as_bytes(texts)], dtype=float).reshape(-1, len(STATISTICS))
        return pa.array(model.scores(rows), pa.float64())

    scored = docs.select(whole_row(docs), score_of(F.col(text_col)).alias("score"))
    return scored.where(F.col("score") >= least).select("row.*")
