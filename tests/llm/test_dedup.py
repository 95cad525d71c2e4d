"""Exact, near and substring deduplication against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from ticketmill.llm import components, exact_dedup, simhash, substring_dedup
from llm_samples import EDGE_ROWS, edge_docs, make_docs, no_docs, sentence, words  # noqa: F401 (two are fixtures)


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def expected_groups(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[digest(text)].append(doc_id)
    result = Counter()
    for key, ids in groups.items():
        keep = min((one for one in ids if one is not None), default=None)
        kept = False
        for one in sorted(ids, key=lambda i: (i is None, i or 0)):
            result[(one, keep, len(ids), not kept and one == keep, key)] += 1
            kept = kept or one == keep
    return result


def test_exact_groups_edge_rows(edge_docs):
    found = Counter(tuple(row) for row in exact_dedup.exact_groups(edge_docs).collect())
    assert found == expected_groups(EDGE_ROWS)


def test_exact_groups_hot_group(spark):
    rows = [(i, "same  text" if i % 3 == 0 else f"text {i % 2000}") for i in range(6000)]
    found = Counter(tuple(row) for row in exact_dedup.exact_groups(make_docs(spark, rows)).collect())
    assert found == expected_groups(rows)


def test_bloom_pass_has_no_false_negative(spark, monkeypatch):
    """A filter far too small lets everything through, and the groups are still right."""
    monkeypatch.setattr(exact_dedup, "MIN_CELLS", 64)
    monkeypatch.setattr(exact_dedup, "MAX_CELLS", 64)
    rows = [(i, f"text {i % 700}") for i in range(1000)]
    found = Counter(tuple(row) for row in exact_dedup.exact_groups(make_docs(spark, rows)).collect())
    assert found == expected_groups(rows)


def test_unique_documents_pass_straight_through(spark):
    docs = make_docs(spark, [(i, f"text {i}") for i in range(500)] + [(900, "text 1")])
    hashed = docs.select("doc_id", exact_dedup.text_digest(F.col("text")).alias("text_sha256"))
    cells = 1 << 20
    looked_up = exact_dedup.with_possible_copies(hashed, exact_dedup.repeated_cells(hashed, cells), cells)
    assert {row.doc_id for row in looked_up.where("possible").collect()} == {1, 900}


def test_exact_groups_without_rows(no_docs):
    assert exact_dedup.exact_groups(no_docs).collect() == []
    assert exact_dedup.drop_exact_copies(no_docs).collect() == []


def test_drop_exact_copies_keeps_columns_and_one_row(edge_docs):
    kept = exact_dedup.drop_exact_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = kept.select("doc_id", "text").collect()
    assert len(rows) == len({digest(row.text) for row in rows}) == len({digest(row[1]) for row in EDGE_ROWS})


# --- near duplicates ----------------------------------------------------------


def brute_fingerprint(text, shingle):
    found = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + shingle]) for i in range(len(found) - shingle + 1)] or [b" ".join(found)]
    votes = Counter()
    for one in shingles:
        value = xxhash.xxh64_intdigest(one, 42)
        votes.update(bit for bit in range(64) if value >> bit & 1)
    return sum(1 << bit for bit in range(64) if 2 * votes[bit] > len(shingles))


@pytest.mark.parametrize("shingle", [1, 3, 5])
def test_fingerprint(shingle):
    texts = [row[1] for row in EDGE_ROWS if row[1] is None or len(row[1]) < 10_000]
    for text in texts:
        assert simhash.fingerprint((text or "").encode(), shingle) == brute_fingerprint(text, shingle)


def test_fingerprint_of_very_long_text():
    text = sentence(12, 140_000)
    assert simhash.fingerprint(text.encode(), 3) == brute_fingerprint(text, 3)


def test_every_word_has_one_code_word_within_the_radius():
    offsets = simhash.anchor_offsets(0)[0]
    assert [len(one) for one in offsets] == [1] * 2048
    assert max(int(one[0]).bit_count() for one in offsets) == simhash.GOLAY_RADIUS


def test_anchors_cover_all_points_within_the_threshold():
    import itertools
    import random

    rng = random.Random(3)
    for _ in range(5):
        point = rng.getrandbits(64)
        home, _ = simhash.anchors_of(point, 2)
        for bits in itertools.chain(*(itertools.combinations(range(64), size) for size in (0, 1, 2))):
            near = point
            for bit in bits:
                near ^= 1 << bit
            reached = simhash.anchors_of(near, 2)[1].tolist()
            assert home in reached
        assert len(reached) == len(set(reached))


def near_points():
    """Points in clusters: chains of up to two flipped bits, copies and strangers."""
    import random

    rng = random.Random(7)
    points = [0]
    for _ in range(60):
        point = rng.getrandbits(64)
        points.append(point)
        for _ in range(rng.randint(0, 12)):
            for _ in range(rng.randint(1, 4)):
                point ^= 1 << rng.randrange(64)
            points.append(point)
    return list(dict.fromkeys(points))


def test_links_against_brute_force(spark):
    points = [one - (1 << 64) if one >> 63 else one for one in near_points()]
    frame = spark.createDataFrame([(one,) for one in points], "point long")
    found = [tuple(row) for row in simhash.near_links(frame, 2).collect()]
    wanted = {
        (a, b)
        for a in points
        for b in points
        if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2
    }
    assert len(found) == len(set(found))
    assert set(found) == wanted and len(wanted) > 50


def components_of(nodes, links):
    parent = {node: node for node in nodes}

    def root(node):
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    for a, b in links:
        parent[root(a)] = root(b)
    return {node: root(node) for node in nodes}


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 500 + i) for i in range(1, 60)]
    links += [(700 + i, 700 + (i + 1) % 9) for i in range(9)] + [(900, 900)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = {row.node: row.root for row in components.connected_components(frame).collect()}
    real = [pair for pair in links if pair[0] != pair[1]]
    wanted = components_of({one for pair in real for one in pair}, real)
    assert found.keys() == wanted.keys()
    assert len(set(found.values())) == len(set(wanted.values())) == 3
    assert all(found[a] == found[b] for a, b in links if a != b)


def test_near_duplicates_against_brute_force(edge_docs):
    found = Counter(tuple(row) for row in simhash.near_duplicates(edge_docs).collect())
    points = [(row[0], brute_fingerprint(row[1], 3)) for row in EDGE_ROWS]
    distinct = {point for _, point in points}
    links = [(a, b) for a in distinct for b in distinct if (a ^ b).bit_count() <= 2]
    roots = components_of(distinct, links)
    least = {}
    for doc_id, point in points:
        if doc_id is not None:
            least[roots[point]] = min(doc_id, least.get(roots[point], doc_id))
    assert found == Counter((i, f"{p:016x}", least.get(roots[p])) for i, p in points)


def test_near_copies_of_a_long_text_are_one_component(spark):
    base = words(20, 400)
    rows = [(0, " ".join(base))] + [(i, " ".join(base[: 400 - i] + ["x"] + base[400 - i :])) for i in range(1, 6)]
    docs = make_docs(spark, [*rows, (100, sentence(21, 400))])
    kept = simhash.drop_near_duplicates(docs, 3, 2)
    classes = {row.doc_id: row.component_id for row in simhash.near_duplicates(docs, 3, 2).collect()}
    assert kept.columns == docs.columns
    assert {row.doc_id for row in kept.collect()} == set(classes.values()) and classes[100] == 100


def linked_texts(texts):
    """Texts by component: each with the texts it is linked to, over any number of links."""
    points = {text: brute_fingerprint(text, 3) for text in texts}
    sets = []
    for text, point in points.items():
        near = [one for one in sets if any((points[other] ^ point).bit_count() <= 2 for other in one)]
        sets = [one for one in sets if one not in near] + [set().union({text}, *near)]
    return sets


def test_one_row_of_each_component_stays(spark):
    base = words(20, 400)
    edited = lambda i: " ".join(base[: 400 - i] + ["x"] + base[400 - i :])
    alone = [sentence(30 + i, 50) for i in range(5)]
    other = words(23, 400)
    rows = [
        (1, edited(1)),
        (None, edited(2)),  # its component has an id
        (None, alone[0]),
        (None, alone[1]),
        (2, edited(3)),
        (2, alone[2]),  # shares an id with a near copy
        (3, alone[3]),
        (3, alone[3]),  # repeats an id and a text
        (None, alone[4]),
        (None, alone[4]),
        (None, " ".join(other)),  # near copies, none of which has an id
        (None, " ".join(["x", *other])),
    ]
    rows += [row for row in EDGE_ROWS if row[0] != 9]
    docs = make_docs(spark, rows).repartition(3)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    found = Counter((row.doc_id, row.text) for row in kept.collect())
    assert set(found.values()) == {1}
    for component in linked_texts({text for _, text in rows}):
        stays = [one for one in found if one[1] in component]
        ids = [doc_id for doc_id, text in rows if text in component and doc_id is not None]
        assert len(stays) == 1 and stays[0] in rows and stays[0][0] == min(ids, default=None)


def test_near_duplicates_without_rows(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.drop_near_duplicates(no_docs).collect() == []


# --- substrings ---------------------------------------------------------------


def brute_removal(rows, length):
    split = [(row[0], re.findall(r"[^\x20\x09-\x0d]+", row[1] or "")) for row in rows]
    seen = Counter(tuple(w[i : i + length]) for _, w in split for i in range(len(w) - length + 1))
    result = Counter()
    for doc_id, found in split:
        covered = [False] * len(found)
        for i in range(len(found) - length + 1):
            if seen[tuple(found[i : i + length])] > 1:
                covered[i : i + length] = [True] * length
        kept = [word for word, gone in zip(found, covered) if not gone]
        result[(doc_id, len(found), sum(covered), hashlib.sha256(" ".join(kept).encode()).hexdigest())] += 1
    return result


@pytest.mark.parametrize("unit_words", [1 << 21, 100])
def test_remove_repeats_against_brute_force(edge_docs, monkeypatch, unit_words):
    monkeypatch.setattr(substring_dedup, "UNIT_WORDS", unit_words)
    found = Counter(tuple(row) for row in substring_dedup.remove_repeats(edge_docs, 35).collect())
    assert found == brute_removal(EDGE_ROWS, 35)


@pytest.mark.parametrize("length", [1, 2, 7])
def test_remove_repeats_of_short_windows(spark, length):
    rows = [(i, sentence(i % 17, 5 + i % 11)) for i in range(60)] + [(100, "x x x x"), (101, None)]
    found = Counter(tuple(row) for row in substring_dedup.remove_repeats(make_docs(spark, rows), length).collect())
    assert found == brute_removal(rows, length)


def test_places_survive_packing():
    import numpy as np

    for places in ([], [0], [3, 4, 70_000, 20_000_000]):
        array = np.array(places, dtype=np.int64)
        assert substring_dedup.unpack_places(substring_dedup.pack_places(array)).tolist() == places


def test_remove_repeats_without_rows(no_docs):
    assert substring_dedup.remove_repeats(no_docs).collect() == []
