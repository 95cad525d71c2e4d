"""Byte-level BPE and packing: exact round trips, library results and small optima."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_samples import EDGE_ROWS, edge_docs, make_docs, no_docs, sentence  # noqa: F401 (two are fixtures)
from tokenizers import Tokenizer

from ticketmill.llm import byte_bpe, packing
from ticketmill.llm.chunks import Memo, PieceCache, split_pieces

RANKS_PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON_PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = byte_bpe.read_ranks(RANKS_PATH)
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)
ENCODER = byte_bpe.ByteBPE(RANKS, public_tokenizers.PATTERN)

ODD_TEXTS = [
    "",
    " ",
    "  a  b",
    " a\n\n b",
    "x \ny",
    "\x1c \x1d a \x85 b\x85c",
    "it's  we'll  'S don't",
    "foo   bar\t\t baz \n",
    "日本語 テスト 🙂🙂 x",
    "​　  a",
    "a" * 5_000,
    " " * 3_000 + "x",
    "!?" * 500,
    "ªº ﬁ ǅ ₂ Ⅷ ٣",
    "<|endoftext|> x",
]


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_ids_are_the_library_ids(text):
    assert ENCODER.encode(text) == LIBRARY.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8")))
def test_ids_of_any_text(text):
    ids = ENCODER.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert ENCODER.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" ab'\n\t!1é　\x85\x1c"))
def test_pieces_are_encoded_like_the_whole(text):
    first, *rest = split_pieces(text)
    assert " ".join([first, *rest]) == text
    pieces = [first, *(" " + one for one in rest)]
    assert [i for one in pieces for i in LIBRARY.encode_ordinary(one)] == LIBRARY.encode_ordinary(text)


def test_pairs_fit_as_the_plain_merges_say():
    rng = random.Random(1)
    tokens = rng.sample(sorted(RANKS), 3_000)
    checked = 0
    for left, right in zip(tokens, tokens[1:]):
        merged = [left + right] if left + right in RANKS else None
        whole = merged or [
            ENCODER.tokens[i] for i in tiktoken.Encoding(
                "raw", pat_str=r"(?s).+", mergeable_ranks=RANKS, special_tokens={}
            )._encode_single_piece(left + right)
        ]
        assert ENCODER.pair_fits(left.decode("latin-1"), right.decode("latin-1")) == (whole == [left, right])
        checked += 1
    assert checked == 2_999


def test_cache_keeps_results_when_it_is_full():
    calls = []

    def double(key):
        calls.append(key)
        return key * 2

    memo = Memo(double, size=4)
    for _ in range(3):
        assert memo.of(range(10)) == [2 * i for i in range(10)]
    cache = PieceCache(lambda piece: piece.encode(), size=4)
    for text in ODD_TEXTS * 2:
        assert b"".join(cache.encode(text)) == text.encode()


TOKENIZER = Tokenizer.from_file(JSON_PATH)
PACKING_ENCODER = packing.TextEncoder(JSON_PATH)


def piece_ids(text):
    return np.frombuffer(b"".join(PACKING_ENCODER.encode(text)), dtype="<u4").tolist()


@pytest.mark.parametrize("text", [*ODD_TEXTS, "a<|endoftext|>b c", "x.\n\nY's  'll we'LL 12a3 ½Ⅷ ª", "Ġ Ċ\tĠa", "don't.\n 'Tis"])
def test_pieces_have_the_tokenizers_ids(text):
    assert piece_ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(
    st.text(alphabet=st.characters(codec="utf-8"))
    | st.text(alphabet=" ab'st\n\t!1é　\x85\x1cĠ<|>")
    | st.text(alphabet=st.characters(max_codepoint=0x24F) | st.sampled_from(" \n'") | st.characters(min_codepoint=0x2010, max_codepoint=0x2030))
)
def test_pieces_of_any_text_have_the_tokenizers_ids(text):
    assert piece_ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_each_usual_character_is_treated_as_the_tokenizer_does():
    for one in map(chr, [*range(0x250), *range(0x2000, 0x2070)]):
        text = f"a{one}b {one} {one}{one}1{one}\n{one}\n\n {one}"
        assert piece_ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_other_kinds_of_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        packing.TextEncoder(public_tokenizers.path("word_bpe_49k.json"))


def test_digests_of_edge_rows(edge_docs):
    found = Counter(
        tuple(row) for row in byte_bpe.bpe_digests(edge_docs, RANKS_PATH, public_tokenizers.PATTERN).collect()
    )
    wanted = Counter()
    for doc_id, text, *_ in EDGE_ROWS:
        ids = LIBRARY.encode_ordinary(text or "")
        numerals = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        wanted[(doc_id, len(ids), numerals, hashlib.sha256((text or "").encode()).hexdigest())] += 1
    assert found == wanted


def test_round_trip_of_edge_rows(edge_docs):
    rows = byte_bpe.bpe_round_trip(edge_docs, RANKS_PATH, public_tokenizers.PATTERN).collect()
    texts = Counter((row[0], (row[1] or "").encode()) for row in EDGE_ROWS)
    assert Counter((row.doc_id, bytes(row.decoded)) for row in rows) == texts
    for row in rows:
        assert LIBRARY.decode_bytes(np.frombuffer(row.ids, "<u4").tolist()) == bytes(row.decoded)


def test_no_documents_no_ids(no_docs):
    assert byte_bpe.bpe_digests(no_docs, RANKS_PATH, public_tokenizers.PATTERN).collect() == []


# --- packing ------------------------------------------------------------------


def optimum(items, capacity):
    best = [len(items)]
    items = sorted(items, reverse=True)

    def place(at, bins):
        if len(bins) >= best[0]:
            return
        if at == len(items):
            best[0] = len(bins)
            return
        for k in {room: k for k, room in enumerate(bins) if room + items[at] <= capacity}.values():
            bins[k] += items[at]
            place(at + 1, bins)
            bins[k] -= items[at]
        place(at + 1, [*bins, items[at]])

    place(0, [])
    return best[0]


def instances():
    rng = random.Random(5)
    for _ in range(400):
        capacity = rng.choice([10, 20, 30])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        yield Counter(items), capacity


def test_reduction_keeps_the_optimum():
    fixed_any = 0
    for counts, capacity in instances():
        instance = packing.Instance(dict(counts), capacity)
        fixed = packing.reduce_instance(instance)
        fixed_any += fixed > 0
        rest = [size for size, count in instance.left.items() for _ in range(count)]
        assert fixed + (optimum(rest, capacity) if rest else 0) == optimum(list(counts.elements()), capacity)
    assert fixed_any > 200


def test_rules_place_every_item_once_and_without_gaps():
    for counts, capacity in instances():
        rules, sequences, _ = packing.plan_packing(dict(counts), capacity)
        placed, filled = Counter(), {}
        for size, first, items, sequence, each, offset in rules:
            assert first == placed[size]
            placed[size] += items
            for i in range(items):
                filled.setdefault(sequence + i // each, []).append((offset + i % each * size, size))
        assert placed == counts and set(filled) == set(range(sequences))
        for parts in filled.values():
            at = 0
            for offset, size in sorted(parts):
                assert offset == at
                at += size
            assert at <= capacity
        assert sequences <= optimum(list(counts.elements()), capacity) + 1


def test_plan_does_not_grow_with_the_counts():
    small = {size: 3 + size % 7 for size in range(1, 2048)}
    large = {size: count * 10**9 for size, count in small.items()}
    rules, sequences, _ = packing.plan_packing(large, 2048)
    assert len(rules) < 20 * 2048
    assert sequences <= 1.001 * sum(size * count for size, count in large.items()) / 2048


def check_packing(rows, packed, capacity):
    tokenizer = Tokenizer.from_file(JSON_PATH)
    wanted = Counter()
    for doc_id, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        first = len(ids) % capacity or capacity
        borders = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(borders, borders[1:])):
            wanted[(doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter(tuple(row)[:5] for row in packed) == wanted
    sequences = {}
    for row in packed:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_of_edge_rows(edge_docs):
    packed = packing.pack_documents(edge_docs, JSON_PATH, 2048).collect()
    sequences = check_packing(EDGE_ROWS, packed, 2048)
    assert sequences == -(-sum(row.length for row in packed) // 2048)


def test_packing_of_many_equal_documents(spark):
    rows = [(i, "same text") for i in range(3000)] + [(5000 + i, sentence(i, i)) for i in range(60)]
    packed = packing.pack_documents(make_docs(spark, rows), JSON_PATH, 64).collect()
    check_packing(rows, packed, 64)


def test_packing_nothing(no_docs):
    assert packing.pack_documents(no_docs, JSON_PATH).collect() == []


def test_too_long_pieces_are_refused(spark):
    pieces = spark.createDataFrame([(1, 0, 0, 9, 1)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    with pytest.raises(ValueError):
        packing.pack_pieces(pieces, 8)
