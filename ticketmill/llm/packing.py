"""Best-fit packing of documents into sequences of a fixed length (operator 2).

A document's length is its ids plus one closing id. A longer one is cut into full pieces;
its first piece takes the rest. Full pieces are sequences of their own.

The others are a bin-packing instance whose items are plain lengths, so the instance is a
histogram with at most one entry per length, however many documents there are. Only that
histogram reaches the driver. There, Martello-Toth reduction fixes the sets that dominate
every alternative for their largest item, again and again on the shrinking instance; best
fit decreasing packs the remainder. Both work on whole classes of equal lengths and give
rules: pieces number a to b of length s go, k to a sequence, to the sequences from q on.

Pieces are numbered within their length by a hashed bucket and then by document, so that a
length held by a third of all pieces is spread over all buckets.

Defined results: null and empty texts are one closing id. Repeated rows are packed one by
one. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.llm.chunks import Memo, PieceCache
from ticketmill.llm.common import arrow_map, as_texts, id_and_text, written

CLOSING_ID = 0
# Pieces per numbering bucket, about.
BUCKET_PIECES = 4_096
MIN_BUCKETS = 512
# Remembered matches and pieces per Python worker, of some 170 bytes each.
KNOWN_MATCHES = 600_000
KNOWN_PIECES = 200_000
# Packers of few ids.
_PACKERS = [struct.Struct(f"<{ids}I").pack for ids in range(32)]

# Characters of which the splitter's pattern treats the first as letters, ASCII digits as
# digits, space and line end as white space, and the other ones as none of these.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_USUAL = re.compile(rf"[ -~\n{_LETTERS}¡-©«¬®-±´¶-¸»¿×÷‐-‧]*").fullmatch
# What the pattern matches in texts of these characters only.
_MATCHES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^ \n0-9{_LETTERS}]+|[ \n]+(?![^ \n])|[ \n]+"
).findall


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary, by the byte's Latin-1 character.

    Printable ones stand for themselves, the others for the characters from 256 on.
    """
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(256 + at) for at, byte in enumerate(others)}


class TextEncoder:
    """Encodes texts as the tokenizer does; ids of matches and pieces are remembered.

    Texts of usual characters are split into the matches of the tokenizer's pattern here,
    others at spaces and then by the tokenizer's own splitter. What isn't known yet goes
    through its model. A piece with an added token's text is left to the tokenizer whole.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_path)
        parts = json.loads(self._tokenizer.to_str())
        splitter = parts["pre_tokenizer"] or {}
        plain = splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get("add_prefix_space")
        if not plain or parts["normalizer"] or parts["model"].get("dropout"):
            raise ValueError("Texts are cut at spaces: this needs a byte-level tokenizer without normalizer or dropout")
        self._added = [token["content"] for token in parts["added_tokens"]]
        self._split = self._tokenizer.pre_tokenizer.pre_tokenize_str
        self._model = self._tokenizer.model.tokenize
        self._bytes = _byte_characters()
        self._matches = Memo(self._match_ids, KNOWN_MATCHES)
        self._pieces = PieceCache(self._piece_ids, KNOWN_PIECES)

    def encode(self, text: str) -> list[bytes]:
        """Ids of the text's parts, in order, little-endian."""
        if _USUAL(text) and not any(token in text for token in self._added):
            return self._matches.of(_MATCHES(text))
        return self._pieces.encode(text)

    def _model_ids(self, mapped: str) -> bytes:
        ids = [token.id for token in self._model(mapped)]
        return _PACKERS[len(ids)](*ids) if len(ids) < len(_PACKERS) else struct.pack(f"<{len(ids)}I", *ids)

    def _match_ids(self, match: str) -> bytes:
        if match.isascii() and match[1:].isalpha():
            return self._model_ids("Ġ" + match[1:] if match[0] == " " else match)
        return self._model_ids(match.encode().decode("latin-1").translate(self._bytes))

    def _piece_ids(self, piece: str) -> bytes:
        if piece[1:].isalpha() and (piece[0] == " " or piece[0].isalpha()):
            return self._match_ids(piece)
        if any(token in piece for token in self._added):
            return np.array(self._tokenizer.encode(piece, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(self._model_ids(match) for match, _ in self._split(piece))


@lru_cache(maxsize=2)
def worker_encoder(tokenizer_path: str) -> TextEncoder:
    """One tokenizer and its memory per Python worker."""
    return TextEncoder(tokenizer_path)


def cut_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_path)
        closing = np.array([CLOSING_ID], dtype="<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), as_texts(batch.column("text"))):
                ids = b"".join([*encoder.encode(text), closing])
                size = len(ids) // 4
                first = size % capacity or capacity
                borders = [0, *range(first, size + 1, capacity)]
                for piece, (start, end) in enumerate(zip(borders, borders[1:])):
                    rows.append((doc_id, piece, start, end - start, zlib.crc32(ids[4 * start : 4 * end])))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(values, kind)
                    for values, kind in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return arrow_map(
        id_and_text(docs, id_col, text_col),
        cut,
        "doc_id long, piece int, start long, length long, ids_crc32 long",
    )


class Instance:
    """A bin-packing instance by length: how many items of each length are left, and the rules made so far."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {size: count for size, count in counts.items() if count > 0}
        self.sizes = sorted(self.left)
        self.used = dict.fromkeys(self.left, 0)
        self.sequences = 0
        # (length, first item, items, first sequence, items per sequence, offset in the sequence)
        self.rules: list[tuple[int, int, int, int, int, int]] = []

    def place(self, size: int, items: int, sequence: int, each: int, offset: int) -> None:
        self.rules.append((size, self.used[size], items, sequence, each, offset))
        self.used[size] += items
        self.left[size] -= items
        if not self.left[size]:
            del self.left[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def fix(self, sizes: list[int], times: int) -> None:
        """Close ``times`` sequences, each holding one item of every given length."""
        offset = 0
        for size in sizes:
            self.place(size, times, self.sequences, 1, offset)
            offset += size
        self.sequences += times

    def largest_fitting(self, room: int, taken: list[int]) -> int:
        """The largest length up to ``room`` that has an item besides those taken; 0 if none has."""
        at = bisect_right(self.sizes, room) - 1
        while at >= 0 and self.left[self.sizes[at]] <= taken.count(self.sizes[at]):
            at -= 1
        return self.sizes[at] if at >= 0 else 0

    def smallest(self, how_many: int, taken: list[int]) -> int | None:
        """The sum of the smallest items besides those taken; None if there are fewer."""
        total, missing = 0, how_many
        for size in self.sizes[: how_many + len(taken) + 1]:
            count = min(missing, self.left[size] - taken.count(size))
            total, missing = total + size * max(0, count), missing - max(0, count)
            if not missing:
                return total
        return None

    def best_pair(self, room: int, taken: list[int]) -> tuple[int, int]:
        """The two items besides those taken with the largest sum up to ``room``, larger first; zeros if none fit."""
        best = (0, 0)
        low, high = 0, len(self.sizes) - 1
        free = lambda size: self.left[size] - taken.count(size)
        while low <= high:
            small, large = self.sizes[low], self.sizes[high]
            if small + large > room or not free(large):
                high -= 1
            elif not free(small) or (low == high and free(small) < 2):
                low += 1
            else:
                if small + large > sum(best):
                    best = (large, small)
                low += 1
        return best


def dominating_set(instance: Instance, size: int) -> list[int] | None:
    """A set with an item of this length that dominates every feasible set with it, or None.

    A set dominates another if its items can replace, each, a part of the other that
    weighs no more. Sets of up to three items are considered.
    """
    room = instance.capacity - size
    partner = instance.largest_fitting(room, [size])
    if not partner:
        return [size]
    two = instance.smallest(2, [size])
    if partner == room or two is None or two > room:
        return [size, partner]
    three = instance.smallest(3, [size])
    if three is not None and three <= room:
        return None
    # At most two more items fit: the best single one or a pair.
    larger, smaller = instance.best_pair(room, [size])
    if larger + smaller <= partner:
        return [size, partner]
    if larger == partner and smaller == instance.largest_fitting(room - partner, [size, partner]):
        # The best pair holds the best single one. Any other pair has no larger first
        # item, and its second must not be larger either.
        second_best = instance.largest_fitting(room // 2, [size])
        if second_best <= smaller:
            return [size, larger, smaller]
    return None


def reduce_instance(instance: Instance) -> int:
    """Fix dominating sets until none is found; the number of sequences closed that way."""
    before = instance.sequences
    changed = True
    while changed:
        changed = False
        for size in sorted(instance.left, reverse=True):
            while size in instance.left:
                chosen = dominating_set(instance, size)
                if chosen is None:
                    break
                needs = {one: chosen.count(one) for one in chosen}
                # The same set goes on dominating while its lengths last: fewer items are
                # left for the alternatives.
                times = min(instance.left[one] // need for one, need in needs.items())
                instance.fix(chosen, times)
                changed = True
    return instance.sequences - before


def best_fit(instance: Instance) -> None:
    """Best fit decreasing over classes of equal lengths and of equally filled sequences."""
    rooms: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, sequences)
    ordered: list[int] = []

    def add(room: int, first: int, count: int) -> None:
        if count and room:
            if room not in rooms:
                rooms[room] = []
                ordered.insert(bisect_left(ordered, room), room)
            rooms[room].append((first, count))

    for size in sorted(instance.left, reverse=True):
        while size in instance.left:
            at = bisect_left(ordered, size)
            if at < len(ordered):
                room = ordered[at]
                first, count = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                    ordered.pop(at)
            else:
                room, first = instance.capacity, instance.sequences
                count = -(-instance.left[size] // (room // size))
                instance.sequences += count
            each = room // size
            full = min(count, instance.left[size] // each)
            offset = instance.capacity - room
            if full:
                instance.place(size, full * each, first, each, offset)
                add(room - each * size, first, full)
            if full < count:
                rest = instance.left.get(size, 0)
                if rest:
                    instance.place(size, rest, first + full, each, offset)
                    add(room - rest * size, first + full, 1)
                    full += 1
                add(room, first + full, count - full)


def plan_packing(counts: dict[int, int], capacity: int) -> tuple[list[tuple], int, int]:
    """Placement rules for a histogram of lengths, the number of sequences, and how many of them were fixed."""
    instance = Instance(counts, capacity)
    fixed = reduce_instance(instance)
    best_fit(instance)
    return instance.rules, instance.sequences, fixed


def number_pieces(pieces: DataFrame) -> DataFrame:
    """Adds ``rank``: the number of a piece, from 0, among the pieces of its length.

    Pieces are counted per bucket first; a bucket's first number comes from the counts of
    the buckets before it.
    """
    total = pieces.count()
    buckets = max(MIN_BUCKETS, -(-total // BUCKET_PIECES))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    by_length = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        dealt.groupBy("length", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("first", F.coalesce(F.sum("n").over(by_length), F.lit(0)))
        .drop("n")
    )
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    return (
        dealt.withColumn("nth", F.row_number().over(within) - 1)
        .join(firsts, ["length", "bucket"])
        .withColumn("rank", F.col("first") + F.col("nth"))
        .drop("bucket", "first", "nth")
    )


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of at most ``capacity`` ids."""
    spark = pieces.sparkSession
    if pieces.where(F.col("length") > capacity).limit(1).count():
        raise ValueError("a piece is longer than a sequence")
    # One row per length at most, so the histogram is bounded by the capacity.
    counts = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rules, _, _ = plan_packing(counts, capacity)
    schema = "length long, first long, items long, sequence long, each long, at long"
    table = spark.createDataFrame(rules, schema).withColumns(
        {"last": F.col("first") + F.col("items") - 1}
    )
    # Rules of a length as one sorted array; a piece finds its own by halving.
    by_length = table.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("first", "last", "sequence", "each", "at"))).alias("rules")
    )
    numbered = number_pieces(pieces)
    rule = F.filter("rules", lambda one: (one["first"] <= F.col("rank")) & (F.col("rank") <= one["last"]))[0]
    within = F.col("rank") - F.col("rule.first")
    return (
        # Bounded: rules come from a histogram with at most ``capacity`` entries.
        numbered.join(F.broadcast(by_length), "length")
        .withColumn("rule", rule)
        .select(
            *[column for column in pieces.columns],
            (F.col("rule.sequence") + (within / F.col("rule.each")).cast("long")).alias("sequence_id"),
            (F.col("rule.at") + within % F.col("rule.each") * F.col("length")).alias("offset"),
        )
    )


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All documents cut and packed: one row per piece, with its place."""
    return pack_pieces(written(cut_documents(docs, tokenizer_path, capacity, id_col, text_col), "pieces"), capacity)
