"""SimHash near-duplicates by anchor-point covering (operator 4).

A document's fingerprint has the bit majorities of its shingles' 64-bit hashes. Equal
fingerprints are one point, so copies are never compared with each other.

Anchors are the words of a covering code of 64 bits: the product of two perfect Golay codes
of 23 bits, of radius 3 each, and of the single zero word on the other 18 bits. Every point
has exactly one nearest anchor, its home, within the radius of each part. If two points
differ in at most t bits, one lies within the radius plus t of the other's home, part by
part: d1 and d2 bits of the parts differ, so its distances there are at most 3 + d1 and
3 + d2 with d1 + d2 <= t. So each point is sent to its home, and as a probe to every anchor
within the radius plus the threshold; homes and probes meet per anchor and are compared.
A pair is met exactly once at the home of its smaller point. A point has at most
1 + 64 + 2,016 others within two bits, so links stay in proportion to points.

Defined results: null texts count as empty. A text without words has fingerprint zero,
which links like any other. A text with fewer words than a shingle is one shingle. Repeated
rows share a fingerprint. Null ids come out as they are and name no component as long as
another id does. Other columns are not read.

``drop_near_duplicates`` keeps exactly one row of each component: that with the smallest id,
null ids last; of rows that share this id, or if there is none, that with the smallest text
hash; and of rows that repeat id and text, any one. A row is told by its id and its text, so
what happens to it never depends on rows of other components that share its id or lack one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import arrow_map, as_bytes, id_and_text, written
from ticketmill.llm.components import connected_components
from ticketmill.llm.named_rows import named_apart

# The binary Golay code of 23 bits, 12 of them free, as multiples of its
# generator x^11 + x^9 + x^7 + x^6 + x^5 + x + 1; perfect with radius 3.
GOLAY_BITS = 23
GOLAY_FREE_BITS = 12
GOLAY_GENERATOR = 0b101011100011
GOLAY_RADIUS = 3
HASH_SEED = 42


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of a text's word shingles; A-Z are lower-cased, words end at ASCII white space."""
    words = text.lower().split()  # of bytes, so only ASCII is touched
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = max(1, len(words) - shingle + 1)
    ends = ends[-count:] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], HASH_SEED) for a, b in zip(starts[:count].tolist(), ends.tolist())]
    votes = np.zeros(64, dtype=np.int64)
    array = np.array(hashes, dtype="<u8")
    for at in range(0, count, 65_536):  # bounds the unpacked bits of a very long text
        votes += np.unpackbits(array[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(2 * votes > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash and point (the fingerprint as a signed long) of every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = [fingerprint(text, shingle) for text in as_bytes(batch.column("text"))]
            signed = pa.array(np.array(points, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), signed], names=["doc_id", "text_hash", "point"]
            )

    rows = id_and_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    return arrow_map(rows, hashed, "doc_id long, text_hash long, point long")


def _remainders(words: np.ndarray) -> np.ndarray:
    """Syndromes: remainders of the words, as polynomials, by the generator."""
    rest = words.astype(np.int64)
    for bit in range(GOLAY_BITS - 1, GOLAY_BITS - GOLAY_FREE_BITS - 1, -1):
        shift = bit - (GOLAY_BITS - GOLAY_FREE_BITS)
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY_GENERATOR << shift), rest)
    return rest


@lru_cache(maxsize=4)
def anchor_offsets(threshold: int) -> list[list[np.ndarray]]:
    """For each excess e up to ``threshold`` and each syndrome, the flips that lead to the code words at distance radius + e.

    Excess 0 has the one code word within the radius.
    """
    from itertools import combinations

    per_excess: list[list[np.ndarray]] = []
    by_syndrome: dict[int, list[int]] = {}
    for weight in range(GOLAY_RADIUS + threshold + 1):
        flips = np.array(
            [sum(1 << bit for bit in bits) for bits in combinations(range(GOLAY_BITS), weight)], dtype=np.int64
        )
        if weight == 0 or weight > GOLAY_RADIUS:
            by_syndrome = {}
        for flip, syndrome in zip(flips.tolist(), _remainders(flips).tolist()):
            by_syndrome.setdefault(syndrome, []).append(flip)
        if weight >= GOLAY_RADIUS:
            size = 1 << (GOLAY_BITS - GOLAY_FREE_BITS)
            per_excess.append([np.array(by_syndrome.get(s, []), dtype=np.int64) for s in range(size)])
    return per_excess


def anchors_of(point: int, threshold: int) -> tuple[int, np.ndarray]:
    """The home anchor of a point (unsigned), and all anchors within the radius plus the threshold."""
    offsets = anchor_offsets(threshold)
    parts = np.array([point & ((1 << GOLAY_BITS) - 1), point >> GOLAY_BITS & ((1 << GOLAY_BITS) - 1)], dtype=np.int64)
    low, high = _remainders(parts).tolist()
    near = [
        [parts[part] ^ offsets[excess][syndrome] for excess in range(threshold + 1)]
        for part, syndrome in ((0, low), (1, high))
    ]
    reached = [
        (first[:, None] | second[None, :] << GOLAY_BITS).ravel()
        for a, first in enumerate(near[0])
        for second in near[1][: threshold + 1 - a]
    ]
    return int(reached[0][0]), np.concatenate(reached)


def near_links(points: DataFrame, threshold: int) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct points that differ in at most ``threshold`` bits, each pair once."""

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = np.asarray(batch.column("point"), dtype=np.int64)
            anchors = [anchors_of(point, 0)[0] for point in signed.view(np.uint64).tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors, pa.int64()), batch.column("point")], names=["anchor", "a"]
            )

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = np.asarray(batch.column("point"), dtype=np.int64)
            reached = [anchors_of(point, threshold)[1] for point in signed.view(np.uint64).tolist()]
            if reached:
                repeats = np.fromiter(map(len, reached), dtype=np.int64, count=len(reached))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(reached), pa.int64()), pa.array(np.repeat(signed, repeats), pa.int64())],
                    names=["anchor", "b"],
                )

    home = arrow_map(points, homes, "anchor long, a long")
    probe = arrow_map(points, probes, "anchor long, b long")
    # A hot anchor is a large partition of an ordinary equi-join, which adaptive execution splits.
    return home.join(
        probe.hint("merge"),
        (home["anchor"] == probe["anchor"])
        & (F.col("a") < F.col("b"))
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold),
    ).select("a", "b")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, threshold: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    hashed = written(fingerprints(docs, shingle, id_col, text_col).select("doc_id", "point"), "fingerprints")
    points = written(hashed.groupBy("point").agg(F.min("doc_id").alias("least")), "points")
    roots = connected_components(near_links(points.select("point"), threshold))
    rooted = points.join(roots.withColumnRenamed("node", "point"), "point", "left").select(
        "point", "least", F.coalesce("root", "point").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    components = written(rooted.join(least, "root").select("point", "component_id"), "components")
    digits = F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint")
    return hashed.join(components, "point").select("doc_id", digits, "component_id")


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 3, threshold: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each component.

    That is the row with the smallest id, null ids last; of equal ids, the one with the
    smaller hash of its text; of rows that repeat both, any one. Rows without words are one
    component. An empty table stays empty.
    """
    hashed = fingerprints(docs, shingle, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    # Equal rows of an id and a text become one with their number.
    rows = written(
        hashed.groupBy("doc_id", "text_hash", "point").agg(F.count(F.lit(1)).alias("rows")), "fingerprints"
    )
    points = written(rows.groupBy("point").agg(F.min(order).alias("least")), "points")
    roots = connected_components(near_links(points.select("point"), threshold))
    rooted = points.join(roots.withColumnRenamed("node", "point"), "point", "left").select(
        "point", "least", F.coalesce("root", "point").alias("root")
    )
    stays = (
        rooted.groupBy("root")
        .agg(F.min("least").alias("least"))
        .select(F.col("least.doc_id").alias("__id"), F.col("least.text_hash").alias("__text"), F.lit(True).alias("__stays"))
    )
    # Only rows that go, and those of which one stays, are named; all others pass by unshuffled.
    named = written(
        rows.join(stays, F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__text") == F.col("text_hash")), "left")
        .where("__stays is null or rows > 1")
        .select("doc_id", "text_hash", F.coalesce("__stays", F.lit(False)).alias("stays")),
        "named",
    )
    unnamed, met = named_apart(docs, named, id_col, text_col)
    false_alarms = met.where("found is null").select("row.*")
    one_of_each = met.where("found.stays").dropDuplicates(["doc_id", "text_hash"]).select("row.*")
    return unnamed.union(false_alarms).union(one_of_each)
