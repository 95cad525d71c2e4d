"""Document fingerprints by winnowing (operator 7).

Every run of ``gram`` code points gets a rolling hash. Of each ``window`` consecutive hashes
the smallest is chosen, the rightmost of equal ones, and kept with its position. So two
texts that share any run of ``gram + window - 1`` code points share a chosen hash, and
nothing shorter than ``gram`` is ever matched. Likeness is the Jaccard index of the chosen
hashes, by the same rule at every length.

``fingerprint_chain`` also compares each document with the next one in ascending id, and
with an edited text made from both. For that the texts are dealt out once by ranges of (id, hash
of the text); the document that begins a range is sent to the range before it as well, and the
very first to the last range, so every range is complete in itself. So rows without an id, or
with one id, have several ranges; only rows that repeat an id and a text share one.

Defined results: a null text counts as empty; an empty text has no hash, is like another
empty one (1.0) and unlike any other (0.0). A text shorter than ``gram`` has one hash, of the
whole text. Documents of equal ids follow each other by a hash of their texts; null ids come
last. A single document is its own next. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import arrow_map, as_texts, id_and_text, mix64, rolling_hashes

GRAM = 8
WINDOW = 6
HASH_BASE = 0x9E3779B97F4A7C15
# Ranges of ids: about so many bytes of text each.
RANGE_BYTES = 4 << 20
MIN_RANGES = 1_024
MAX_RANGES = 100_000
SAMPLED_PER_RANGE = 16
RANGES_PER_TASK = 8


def gram_hashes(text: str, gram: int = GRAM) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if not len(points):
        return points
    return mix64(rolling_hashes(points + np.uint64(1), min(gram, len(points)), HASH_BASE))


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Ascending positions of the chosen hashes."""
    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    window = min(window, len(hashes))
    least, at = hashes, np.arange(len(hashes), dtype=np.int64)
    done = 1
    while done < window:
        # Two stretches put together; overlapping ones serve a width that is no power of two.
        step = min(done, window - done)
        size = len(least) - step
        right = least[step:] <= least[:size]
        least, at = np.where(right, least[step:], least[:size]), np.where(right, at[step:], at[:size])
        done += step
    # Chosen positions never go back from one window to the next.
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


class Fingerprint:
    """Chosen hashes of a text with their positions."""

    def __init__(self, text: str, gram: int = GRAM, window: int = WINDOW):
        hashes = gram_hashes(text, gram)
        self.positions = winnow(hashes, window)
        self.hashes = hashes[self.positions]
        self.distinct = np.unique(self.hashes)

    def digest(self) -> str:
        return hashlib.sha256(self.positions.astype("<i8").tobytes() + self.hashes.astype("<u8").tobytes()).hexdigest()

    def likeness(self, other: Fingerprint) -> float:
        shared = len(np.intersect1d(self.distinct, other.distinct, assume_unique=True))
        either = len(self.distinct) + len(other.distinct) - shared
        return shared / either if either else 1.0


def fingerprint_documents(
    docs: DataFrame, gram: int = GRAM, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id, positions and hashes of its fingerprint, in order of position."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = [Fingerprint(text, gram, window) for text in as_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([one.positions for one in chosen], pa.list_(pa.int64())),
                    pa.array([one.hashes.view(np.int64) for one in chosen], pa.list_(pa.int64())),
                ],
                names=["doc_id", "positions", "hashes"],
            )

    return arrow_map(
        id_and_text(docs, id_col, text_col), choose, "doc_id long, positions array<bigint>, hashes array<bigint>"
    )


def edited_text(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many from the start of another text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


# Place of a document: whether its id is missing, the id, the hash of its text.
Place = tuple[bool, int, int]


def _range_starts(plain: DataFrame) -> list[Place]:
    """Places that begin ranges of about equal numbers of documents; each is one of the table's.

    The sample they come from has a fixed number of places per range, each once.
    """
    place = F.struct(
        F.col("doc_id").isNull().alias("missing"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_hash").alias("hash")
    )
    facts = plain.agg(
        F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("rows"), F.min(place).alias("least")
    ).first()
    if not facts["rows"]:
        return []
    ranges = min(MAX_RANGES, max(MIN_RANGES, -(-(facts["bytes"] or 0) // RANGE_BYTES)))
    share = min(1.0, ranges * SAMPLED_PER_RANGE / facts["rows"])
    scale = 1 << 40
    drawn = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(scale)) < int(share * scale)
    sample = sorted(tuple(row) for row in plain.where(drawn).select(place.alias("place")).distinct().select("place.*").collect())
    chosen = [sample[len(sample) * k // ranges] for k in range(ranges)] if sample else []
    return sorted({tuple(facts["least"]), *chosen})


def with_ranges(plain: DataFrame) -> DataFrame:
    """Deals documents out by range, each range in order and followed by the start of the next (``after``)."""
    rows = plain.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    starts = _range_starts(rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            places = [(one is None, one or 0, text) for one, text in zip(ids, batch.column("text_hash").to_pylist())]
            own = np.array([bisect_right(starts, place) - 1 for place in places], dtype=np.int64)
            begins = np.array([at for at, place in enumerate(places) if starts[own[at]] == place], dtype=np.int64)
            before = (own[begins] - 1) % max(1, len(starts))
            dealt = batch.take(pa.array(np.concatenate((np.arange(len(own)), begins))))
            yield pa.RecordBatch.from_arrays(
                [
                    *dealt.columns,
                    pa.array(np.concatenate((own, before)), pa.int64()),
                    pa.array(np.arange(len(own) + len(begins)) >= len(own), pa.bool_()),
                ],
                names=["doc_id", "text", "text_hash", "range", "after"],
            )

    tasks = int(plain.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        arrow_map(rows, deal, "doc_id long, text string, text_hash long, range long, after boolean")
        .repartition(max(tasks, -(-len(starts) // RANGES_PER_TASK)), "range")
        .sortWithinPartitions("range", "after", F.asc_nulls_last("doc_id"), "text_hash")
    )


def fingerprint_chain(
    docs: DataFrame, gram: int = GRAM, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # range, id, text and fingerprint of the document that waits for its next
        for batch in batches:
            found: list[tuple] = []
            columns = (batch.column(name).to_pylist() for name in ("doc_id", "range", "after"))
            for doc_id, own, after, text in zip(*columns, as_texts(batch.column("text"))):
                if after and (before is None or before[0] != own):
                    continue  # the next one is known already
                chosen = Fingerprint(text, gram, window)
                if before is not None and before[0] == own:
                    edited = edited_text(before[2], text)
                    other = Fingerprint(edited, gram, window) if edited != before[2] else before[3]
                    found.append(
                        (
                            before[1],
                            len(before[2]),
                            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                            before[3].digest(),
                            other.digest(),
                            before[3].likeness(other),
                            before[3].likeness(chosen),
                        )
                    )
                before = None if after else (own, doc_id, text, chosen)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(list(zip(*found)) or [()] * 7, kinds)],
                names=[
                    "doc_id",
                    "n_chars",
                    "edited_sha256",
                    "fingerprint",
                    "edited_fingerprint",
                    "near_edited",
                    "near_next",
                ],
            )

    return arrow_map(
        with_ranges(id_and_text(docs, id_col, text_col)),
        compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
