"""Removal of repeated passages by Rabin-Karp hashes of every fixed-length window (operator 6).

Words end at ASCII white space. A window is ``length`` consecutive words of one document.
Every window gets two polynomial rolling hashes over its words' hashes: one is compared,
the other deals it to a bucket, so a window is told apart by 64 bits and its bucket.

Documents are read in units of about two million words. A unit sends each bucket one row:
the hashes of its distinct windows there, with their places. So a window that a third of all
documents share reaches its bucket once per unit, not once per document. A bucket counts
its hashes; those of several units, and those a unit saw twice itself, are repeated. Their
places go back to the unit, where runs of repeated windows merge into maximal intervals of
words, which finally meet the texts again.

Buckets follow the bytes of the input, so a bucket's memory doesn't grow with it.

Defined results: null, empty and short texts have no window. Windows are judged on the
input. Copies of a document remove each other entirely if they have a window. Rows that
repeat an id and a text are rows like any others. Other columns are not read. The rows of
the input must come in the same order when they are read again (a scan of a written table).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.chunks import Memo
from ticketmill.llm.common import arrow_map, as_bytes, id_and_text, mix64, rolling_hashes, written

UNIT_WORDS = 1 << 21
BUCKET_BYTES = 32 << 20
MIN_BUCKETS = 256
# Odd bases of the two rolling hashes.
COMPARED_BASE = 0x9E3779B97F4A7C15
DEALT_BASE = 0xC2B2AE3D27D4EB4F
WORD_MEMO = 400_000

UNIT_SCHEMA = "bucket int, unit string, hashes binary, places binary, doc_ids binary, texts binary, sizes binary"


def pack_places(places: np.ndarray) -> bytes:
    """Ascending numbers as their differences, byte by byte of weight, compressed."""
    steps = np.diff(places, prepend=0).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack_places(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)


@lru_cache(maxsize=1)
def worker_word_hashes() -> Memo:
    """Remembered hashes of words per Python worker."""
    return Memo(lambda word: xxhash.xxh64_intdigest(word), WORD_MEMO)


def window_places(sizes: np.ndarray, length: int) -> np.ndarray:
    """For words of documents one after another: which positions start a window within its document."""
    starts = np.zeros(int(sizes.sum()), dtype=bool)
    begin = np.cumsum(sizes) - sizes
    for first, size in zip(begin.tolist(), sizes.tolist()):
        if size >= length:
            starts[first : first + size - length + 1] = True
    return np.flatnonzero(starts)


def covered_intervals(places: np.ndarray, length: int) -> np.ndarray:
    """Maximal runs of words covered by windows that start at ascending places: rows of start and end."""
    if not len(places):
        return np.zeros((0, 2), dtype=np.int64)
    breaks = np.flatnonzero(np.diff(places) > length)
    firsts = places[np.concatenate(([0], breaks + 1))]
    lasts = places[np.concatenate((breaks, [len(places) - 1]))]
    return np.stack([firsts, lasts + length], axis=1)


class _Unit:
    """Documents gathered until their windows are sent."""

    def __init__(self, length: int, buckets: int):
        self.length, self.buckets = length, buckets
        self.clear()

    def clear(self) -> None:
        self.ids: list[int | None] = []
        self.texts: list[int] = []
        self.sizes: list[int] = []
        self.hashes: list[np.ndarray] = []
        self.words = 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        words = text.split()
        if len(words) >= self.length:
            hashes = np.array(worker_word_hashes().of(words), dtype=np.uint64)
            self.ids.append(doc_id)
            self.texts.append(xxhash.xxh64_intdigest(text, 42))
            self.sizes.append(len(words))
            self.hashes.append(hashes)
            self.words += len(words)

    def rows(self) -> pa.RecordBatch:
        sizes = np.array(self.sizes, dtype=np.int64)
        words = mix64(np.concatenate(self.hashes))
        places = window_places(sizes, self.length)
        compared = mix64(rolling_hashes(words, self.length, COMPARED_BASE))[places]
        dealt = mix64(rolling_hashes(words, self.length, DEALT_BASE))[places]
        order = np.argsort(compared, kind="stable")
        in_order = compared[order]
        same = in_order[1:] == in_order[:-1]
        first = np.concatenate(([True], ~same))
        twice = np.concatenate((same, [False])) | ~first
        repeated_here = np.sort(places[order[twice]])
        kept = np.sort(order[first])  # one window of each kind, by place
        compared, places = compared[kept], places[kept]
        bucket = (dealt[kept] % np.uint64(self.buckets)).astype(np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        borders = np.searchsorted(bucket[by_bucket], np.arange(self.buckets + 1))
        known = np.array([doc_id is not None for doc_id in self.ids])
        ids = np.array([doc_id or 0 for doc_id in self.ids], dtype=np.int64)
        texts = np.array(self.texts, dtype=np.uint64)
        name = hashlib.sha256(ids.tobytes() + texts.tobytes()).hexdigest()[:32]
        rows = [
            (
                int(name[:8], 16) % self.buckets,
                name,
                None,
                pack_places(repeated_here),
                np.where(known, ids, 0).tobytes() + known.tobytes(),
                texts.tobytes(),
                sizes.tobytes(),
            )
        ]
        for at in range(self.buckets):
            chosen = by_bucket[borders[at] : borders[at + 1]]
            if len(chosen):
                rows.append(
                    (at, name, compared[chosen].tobytes(), pack_places(places[chosen]), None, None, None)
                )
        kinds = (pa.int32(), pa.string(), *[pa.binary()] * 5)
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
            names=["bucket", "unit", "hashes", "places", "doc_ids", "texts", "sizes"],
        )


def _small_batches(batch: pa.RecordBatch, rows: int = 64) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def unit_windows(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """Per unit and bucket the distinct windows; per unit one more row with its documents and what it saw twice."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = _Unit(length, buckets)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))):
                unit.add(doc_id, text)
                if unit.words >= UNIT_WORDS:
                    yield from _small_batches(unit.rows())
                    unit.clear()
        if unit.words:
            yield from _small_batches(unit.rows())

    return arrow_map(docs, gather, UNIT_SCHEMA)


def repeated_places(windows: DataFrame) -> DataFrame:
    """Counts each bucket's hashes; per unit the places of repeated windows, and the unit's documents."""

    def count(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        passed = [
            {name: row[name] for name in ("unit", "places", "doc_ids", "texts", "sizes")}
            for row in rows
            if row["doc_ids"] is not None
        ]
        blocks = [row for row in rows if row["hashes"] is not None]
        if blocks:
            hashes = [np.frombuffer(row["hashes"], dtype=np.uint64) for row in blocks]
            # A hash is once in a block, so meeting it twice means two units.
            every = np.sort(np.concatenate(hashes))
            repeated = np.unique(every[1:][every[1:] == every[:-1]])
            for row, own in zip(blocks, hashes):
                if len(repeated):
                    at = np.minimum(np.searchsorted(repeated, own), len(repeated) - 1)
                    places = unpack_places(row["places"])[repeated[at] == own]
                    if len(places):
                        passed.append({"unit": row["unit"], "places": pack_places(places)})
        return pa.Table.from_pylist(
            passed,
            schema=pa.schema(
                [
                    ("unit", pa.string()),
                    ("places", pa.binary()),
                    ("doc_ids", pa.binary()),
                    ("texts", pa.binary()),
                    ("sizes", pa.binary()),
                ]
            ),
        )

    return windows.groupBy("bucket").applyInArrow(
        count, "unit string, places binary, doc_ids binary, texts binary, sizes binary"
    )


def document_intervals(repeated: DataFrame, length: int) -> DataFrame:
    """Per document with a repeated window: doc_id, text (a hash), intervals of words to remove."""

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        documents = next(row for row in rows if row["doc_ids"] is not None)
        sizes = np.frombuffer(documents["sizes"], dtype=np.int64)
        count = len(sizes)
        ids = np.frombuffer(documents["doc_ids"], dtype=np.int64, count=count)
        known = np.frombuffer(documents["doc_ids"], dtype=bool, offset=8 * count)
        texts = np.frombuffer(documents["texts"], dtype=np.int64)
        marked = np.zeros(int(sizes.sum()), dtype=bool)
        seen_twice = set()
        for row in rows:
            marked[unpack_places(row["places"])] = True
        places = np.flatnonzero(marked)
        begin = np.cumsum(sizes) - sizes
        borders = np.searchsorted(places, np.append(begin, sizes.sum()))
        found = []
        for at in np.flatnonzero(borders[1:] > borders[:-1]).tolist():
            intervals = covered_intervals(places[borders[at] : borders[at + 1]] - begin[at], length)
            key = (int(ids[at]) if known[at] else None, int(texts[at]))
            if key not in seen_twice:
                seen_twice.add(key)
                found.append({"doc_id": key[0], "text_hash": key[1], "intervals": intervals.tolist()})
        return pa.Table.from_pylist(
            found,
            schema=pa.schema(
                [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("intervals", pa.list_(pa.list_(pa.int64())))]
            ),
        )

    return repeated.groupBy("unit").applyInArrow(
        merge, "doc_id long, text_hash long, intervals array<array<bigint>>"
    )


def removal_intervals(docs: DataFrame, length: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text, and intervals [start, end) of words to remove (null if none)."""
    plain = id_and_text(docs, id_col, text_col)
    size = plain.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    buckets = max(MIN_BUCKETS, -(-size // BUCKET_BYTES))
    windows = unit_windows(plain, length, buckets)
    # Units may share a document that is repeated, id and text; its intervals are the same in each.
    intervals = written(
        document_intervals(repeated_places(windows), length).dropDuplicates(["doc_id", "text_hash"]), "intervals"
    ).withColumnRenamed("doc_id", "__id")
    return plain.join(
        intervals,
        F.col("__id").eqNullSafe(plain["doc_id"]) & (F.col("text_hash") == F.xxhash64(plain["text"])),
        "left",
    ).select(plain["doc_id"], plain["text"], "intervals")


def remove_repeats(docs: DataFrame, length: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 of the words that stay, joined by one space."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, digests = [], [], []
            for text, intervals in zip(as_bytes(batch.column("text")), batch.column("intervals").to_pylist()):
                words = text.split()
                sizes.append(len(words))
                kept, at = [], 0
                for start, end in intervals or ():
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests)],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return arrow_map(
        removal_intervals(docs, length, id_col, text_col),
        remove,
        "doc_id long, n_words long, n_removed long, kept_sha256 string",
    )
