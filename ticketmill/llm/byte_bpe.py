"""Byte-level BPE encoding and decoding (operator 10).

Each match of a split pattern is encoded by itself. Bytes are mapped to Latin-1 so that an
Aho-Corasick automaton over the vocabulary finds every token in them in one pass. From the
longest token at the current position the encoder goes on; a token is taken only if the
token before it is compatible, that is, if merging the two tokens' bytes by the ranks gives
exactly these two. Compatibility is remembered per pair. A position from which no token
leads on is marked and never entered again, so the work is linear in the bytes. A sequence
whose neighbours are all compatible is the one that the merges would give.

Defined results: a null or empty text has no ids; ids decode to the text's UTF-8 bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ticketmill.llm.chunks import CACHE_PIECES, Memo, PieceCache
from ticketmill.llm.common import arrow_map, as_texts, id_and_text

# Remembered pairs and split matches per Python worker.
MEMO_ENTRIES = 500_000


class ByteBPE:
    """Encoder and decoder for a vocabulary of byte strings with ranks.

    Inside, bytes are strings of Latin-1 characters, one for each byte.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._ranks = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self._pattern = regex.compile(pattern)
        self.tokens: dict[int, bytes] = {rank: token for token, rank in ranks.items()}
        self._automaton = ahocorasick.Automaton()
        for token in self._ranks:
            self._automaton.add_word(token, len(token))
        self._automaton.make_automaton()
        self._widest = max(map(len, ranks), default=0)
        self._compatible: dict[str, dict[str, bool]] = {}
        self._pairs = 0
        self._endings: dict[str, tuple[list[str], list[int]]] = {}
        self._beginnings: dict[str, tuple[list[str], list[int]]] = {}
        self._matches: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        if text.isascii() and text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return self.encode_match(text)  # one word: a single match
        known, ids = self._matches, []
        if len(known) > MEMO_ENTRIES:
            known.clear()
        for match in self._pattern.findall(text):
            found = known.get(match)
            if found is None:
                found = known[match] = self.encode_match(match)
            ids += found
        return ids

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def encode_match(self, match: str) -> list[int]:
        """Ids of one match of the pattern."""
        ranks = self._ranks
        data = match if match.isascii() else match.encode().decode("latin-1")
        if data in ranks:
            return [ranks[data]]
        size, widest = len(data), self._widest
        reach, pairs = self._automaton.longest_prefix, self._compatible
        ends: list[int] = []  # of the tokens taken so far
        dead: set[int] = set()  # positions from which no token leads to the end
        start, before, fitting, end = 0, "", None, reach(data[:widest])
        while start < size:
            while end > start:
                token = data[start:end]
                if token in ranks and end not in dead:
                    if fitting is None:
                        break
                    fits = fitting.get(token)
                    if fits is None:
                        fits = fitting[token] = self.pair_fits(before, token)
                        self._pairs += 1
                    if fits:
                        break
                end -= 1
            if end > start:
                ends.append(end)
                start, before = end, token
                end = start + reach(data[start : start + widest])
            elif not ends:
                raise ValueError(f"no sequence of tokens for {match[:40]!r}")
            else:
                # Undo the last token and try the next shorter one in its place.
                dead.add(start)
                end = ends.pop() - 1
                start = ends[-1] if ends else 0
                before = data[ends[-2] if len(ends) > 1 else 0 : start]
            if before:
                fitting = pairs.get(before)
                if fitting is None:
                    fitting = pairs[before] = {}
            else:
                fitting = None
        if self._pairs > MEMO_ENTRIES:
            self._pairs = 0
            pairs.clear()
        return [ranks[data[a:b]] for a, b in zip([0, *ends], ends)]

    def pair_fits(self, left: str, right: str) -> bool:
        """Whether merging the bytes of both tokens ends in exactly these two.

        It does unless some merge joins a part that ends ``left`` with a part that begins
        ``right``. Both sides grow by their own merges in the order of the ranks; of equal
        ranks the leftmost goes first.
        """
        never = 1 << 62
        (left_parts, left_ranks), (right_parts, right_ranks) = self._last_parts(left), self._first_parts(right)
        i = j = 0
        while True:
            across = self._ranks.get(left_parts[i] + right_parts[j], never)
            if across < left_ranks[i] and across <= right_ranks[j]:
                return False
            if left_ranks[i] == right_ranks[j] == never:
                return True
            grow_left = left_ranks[i] <= right_ranks[j]
            i, j = i + grow_left, j + (not grow_left)

    def _last_parts(self, token: str) -> tuple[list[str], list[int]]:
        """The parts that end a token while it is merged, with the rank of the merge that ends each part's time."""
        return self._parts(token, self._endings, -1)

    def _first_parts(self, token: str) -> tuple[list[str], list[int]]:
        return self._parts(token, self._beginnings, 0)

    def _parts(self, token: str, known: dict, side: int) -> tuple[list[str], list[int]]:
        if token not in known:
            parts, part = [token], token
            while len(part) > 1 and len(halves := self._merged(part, self._ranks[part])) > 1:
                part = halves[side]
                parts.append(part)
            parts.reverse()
            known[token] = parts, [*(self._ranks[one] for one in parts[1:]), 1 << 62]
        return known[token]

    def _merged(self, data: str, below: int) -> list[str]:
        """The plain merges of a token's bytes by ranks under ``below``, lowest first."""
        parts = list(data)
        while len(parts) > 1:
            rank, at = min((self._ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def worker_encoder(path: str, pattern: str) -> tuple[ByteBPE, PieceCache]:
    """One encoder and its memory per Python worker."""
    encoder = ByteBPE(read_ranks(path), pattern)
    return encoder, PieceCache(lambda piece: np.array(encoder.encode(piece), dtype="<u4").tobytes())


def bpe_round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its ids (little-endian unsigned 32-bit, one after another) and the bytes they decode to.

    ``ranks_path`` is a file that every node has. Repeated rows give a row each; other
    columns of ``docs`` are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, cache = worker_encoder(ranks_path, pattern)
        for batch in batches:
            ids = [b"".join(cache.encode(text)) for text in as_texts(batch.column("text"))]
            decoded = [encoder.decode(np.frombuffer(one, "<u4").tolist()) for one in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                names=["doc_id", "ids", "decoded"],
            )

    return arrow_map(id_and_text(docs, id_col, text_col), encode, "doc_id long, ids binary, decoded binary")


@lru_cache(maxsize=2)
def worker_digester(path: str, pattern: str) -> tuple[PieceCache, Memo]:
    """Remembered numerals of the pieces' ids, and remembered decodings of such numerals, per Python worker."""
    encoder = ByteBPE(read_ranks(path), pattern)
    numerals = PieceCache(lambda piece: "".join(f" {one}" for one in encoder.encode(piece)).encode())
    return numerals, Memo(lambda ids: encoder.decode(map(int, ids.split())), CACHE_PIECES)


def bpe_digests(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document the number of ids and digests of the ids and of the decoded bytes."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numerals, decoded = worker_digester(ranks_path, pattern)
        for batch in batches:
            counts, id_hashes, byte_hashes = [], [], []
            for text in as_texts(batch.column("text")):
                pieces = numerals.encode(text)
                ids = b"".join(pieces)
                counts.append(ids.count(b" "))
                id_hashes.append(sha256(ids[1:]).hexdigest())
                byte_hashes.append(sha256(b"".join(decoded.of(pieces))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_hashes), pa.array(byte_hashes)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return arrow_map(
        id_and_text(docs, id_col, text_col),
        encode,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
