"""Fill-in-middle, the conversation trie and the quality rules against plain Python and SQL."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_samples import EDGE_ROWS, edge_docs, make_docs, no_docs, sentence  # noqa: F401 (two are fixtures)
from pyspark.sql import functions as F

from ticketmill.llm import conversation_trie, fill_in_middle, quality_rules, queries
from ticketmill.llm.common import text_crc

# --- fill in middle -------------------------------------------------------------


def plain_fim(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    draw = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    cuts = sorted(one % (len(tokens) + 1) for one in draw[:2])
    prefix, middle, suffix = ("".join(tokens[a:b]) for a, b in ((0, cuts[0]), cuts, (cuts[1], len(tokens))))
    if not text or re.search("<[PSM]>", text) or draw[2] % 100 >= 90:
        return len(tokens), "plain", None, None, text
    if draw[3] % 100 < 20:
        return len(tokens), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(tokens), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


MARKED = [(100 + at, text) for at, text in enumerate(["<P>", "a<S>b", "x<M", "<P", "P>", "<<P>>", "<S", ">", "é<P>é", "<X>"])]


def test_fill_in_middle_equals_the_plain_way(spark):
    rows = [*EDGE_ROWS, *MARKED, *[(k, sentence(k, k % 40)) for k in range(200, 400)]]
    filled = fill_in_middle.restore(fill_in_middle.transform(make_docs(spark, rows).repartition(3)))
    found = sorted(map(tuple, filled.collect()), key=repr)
    wanted = sorted(((doc_id, *plain_fim(doc_id, text), text or "") for doc_id, text in rows), key=repr)
    assert found == wanted
    assert {row[2] for row in found} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_no_rows(spark, no_docs):  # noqa: F811
    assert fill_in_middle.restore(fill_in_middle.transform(no_docs)).collect() == []


def test_restore_keeps_other_columns_and_refuses_lost_marks(spark):
    outputs = spark.createDataFrame([(1, "psm", "<P>a<S>c<M>b", 2.5)], "`a.b` int, kind string, out string, row double")
    assert [tuple(row) for row in fill_in_middle.restore(outputs, "kind", "out").collect()] == [
        (1, "psm", "<P>a<S>c<M>b", 2.5, "abc")
    ]
    with pytest.raises(Exception, match="marks"):
        fill_in_middle.restore(outputs.withColumn("out", F.lit("<P>a<S>c")), "kind", "out").collect()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab<>PSM é日\n"), min_size=1, max_size=6), st.randoms(use_true_random=False))
def test_scatter_and_gather_are_inverse(texts, rng):
    raw = [text.encode() for text in texts]
    offsets = np.concatenate([[0], np.cumsum([len(one) for one in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    draws = np.array([[rng.getrandbits(32) for _ in range(4)] for _ in raw], dtype=np.int64)
    out, places, count, form, prefix, middle = fill_in_middle.scatter(data, offsets, draws, 10, 50)
    restored, back = fill_in_middle.gather(out, places, form)
    assert restored.tobytes() == data.tobytes() and back.tolist() == offsets.tolist()
    assert count.tolist() == [len(re.findall(r"[A-Za-z]+|[^A-Za-z]", text)) for text in texts]
    for at, text in enumerate(texts):
        made = out[places[at] : places[at + 1]].tobytes().decode()
        a, b = int(prefix[at]), int(prefix[at] + middle[at])
        parts = {"P": text[:a], "M": text[a:b], "S": text[b:]}
        order = {0: "", 1: "PSM", 2: "SPM"}[int(form[at])]
        assert made == (text if not order else "".join(f"<{one}>{parts[one]}" for one in order))


# --- conversation trie ----------------------------------------------------------


def rebuilt_conversations(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = conversation_digest(role, text)
            own[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {conv: [one[2] for one in sorted(turns)] for conv, turns in own.items()}
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        rebuilt[conv] = own.get(conv - int(math.fmod(conv, 100)), [])[:h] + turns[h:]
    return rebuilt


def conversation_digest(role, text):
    from hashlib import md5

    return md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def plain_trie(rebuilt):
    members = defaultdict(list)
    for conv, turns in rebuilt.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
    children = Counter(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        for up in range(len(path) + 1):
            leaves[path[:up]] += not children[path]
            saved[path[:up]] += (len(convs) - 1) * len(path[-1][1]) if path else 0
    return sorted(
        (
            (
                min(convs),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(convs),
                children[path],
                leaves[path],
                saved[path],
                sha256(",".join(str(one) for one in sorted(convs) if len(rebuilt[one]) == len(path)).encode()).hexdigest(),
            )
            for path, convs in members.items()
        ),
        key=repr,
    )


def trie_of(spark, rows, **bounds):
    schema = "conv_id long, turn long, role string, text string, path string, shard long, depth int, `a.b` int"
    frame = spark.createDataFrame([(*row, "x", 1, 2, 3) for row in rows], schema).repartition(3)
    conv_id = F.col("conv_id")
    rebuilt = conversation_trie.graft_openings(
        conversation_trie.turn_sequences(frame), conv_id - conv_id % 100, text_crc(conv_id) % 6, 5
    )
    return sorted(map(tuple, conversation_trie.prefix_trie(rebuilt, **bounds).collect()), key=repr)


def random_turns(seed, convs, most, kinds):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-150, 400), convs):
        for turn in range(rng.randint(1, most)):
            text = rng.choice(["a", "bb", "é日", "", None][:kinds])
            rows.append((conv, turn if rng.random() < 0.9 else None, rng.choice(["u", None]), text))
    return rows


@pytest.mark.parametrize(
    "seed, most, kinds, bounds",
    [
        (1, 4, 2, {}),
        (2, 9, 1, {"shard_turns": 7, "block_cells": 9}),
        (3, 14, 3, {"shard_turns": 40, "block_cells": 60}),
        (4, 30, 5, {"shard_turns": 40, "block_cells": 60}),
        (5, 3, 2, {"shard_turns": 7, "block_cells": 9}),
    ],
)
def test_trie_equals_the_plain_way(spark, seed, most, kinds, bounds):
    rows = random_turns(seed, 30 + 10 * seed, most, kinds)
    assert trie_of(spark, rows, **bounds) == plain_trie(rebuilt_conversations(rows))


def test_trie_of_many_equal_conversations_and_one_very_long_one(spark):
    rows = [(conv, turn, "u", "same") for conv in range(600) for turn in range(4)]
    rows += [(1_000, turn, "u", "same") for turn in range(3_000)] + [(None, 1, "u", "nobody"), (601, 0, "u", "same")]
    rows += rows[:40]  # repeated rows are turns
    assert trie_of(spark, rows, shard_turns=500, block_cells=600) == plain_trie(rebuilt_conversations(rows))


def test_trie_of_no_rows(spark):
    assert trie_of(spark, [(None, 1, "u", "nobody")]) == []
    assert trie_of(spark, []) == []


# --- quality rules --------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words, seen, repeated = WORD.findall(text), set(), 0
    met = Counter(zip(words, words[1:], words[2:]))
    covered = {at + k for at in range(len(words) - 2) if met[tuple(words[at : at + 3])] > 1 for k in range(3)}
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


REPEATS = [
    (300, "a b c a b c a b c a"),
    (301, "a a a a a"),
    (302, "a b"),
    (303, "a b c"),
    (304, "x # y\n\n x # y\nx # y\r\nx # y\n \n \n"),
    (305, sentence(1, 30) + "\n" + sentence(2, 20) + "\n" + sentence(1, 30)),
    (306, "one two three " * 400),
]


def test_counts_equal_the_plain_way(spark):
    rows = [*EDGE_ROWS, *REPEATS]
    found = quality_rules.text_counts(make_docs(spark, rows).repartition(3))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        ((doc_id, *plain_counts(text)) for doc_id, text in rows), key=repr
    )


def exact_tail(trials, hits, chance):
    return sum(math.comb(trials, k) * chance**k * (1 - chance) ** (trials - k) for k in range(hits + 1))


def test_binomial_tail(spark):
    cases = [(0, 0), (1, 0), (72, 0), (73, 0), (100, 1), (200, 3), (500, 24), (1_000, 30), (90, 90)]
    frame = spark.createDataFrame(cases, "n long, k long")
    tail = quality_rules.binomial_tail(F.col("n"), F.col("k"), 0.05)
    for n, k, found in frame.select("n", "k", tail).collect():
        assert found == pytest.approx(1.0 if k > n * 0.05 else exact_tail(n, k, 0.05), rel=1e-9)
    [[large]] = spark.range(1).select(quality_rules.binomial_tail(F.lit(4_000_000), F.lit(199_000), 0.05)).collect()
    assert 0 < large < 0.02


def labelled_sample(spark, good, bad, odd_good, stratum=0):
    """Good rows at the usual rates, ``odd_good`` of them with many symbols, and bad rows with many symbols."""
    rows = [(stratum, [0.5 if at < odd_good else 0.0, 5.0, -5.0, 0.0, 0.0], 1, True) for at in range(good)]
    rows += [(stratum, [0.0, 5.0, -5.0, 0.0, 0.0], 1, False)] * 20 + [(stratum, [0.5, 5.0, -5.0, 0.0, 0.0], 0, False)] * bad
    return spark.createDataFrame(rows, "stratum int, rates array<double>, label int, holdout boolean")


@pytest.mark.parametrize("good, odd", [(71, 0), (72, 0), (200, 3), (200, 4), (400, 12)])
def test_cutoffs_hold_the_risk(spark, good, odd):
    labelled = labelled_sample(spark, good, 30, odd)
    chosen = quality_rules.choose_cutoffs(labelled, quality_rules.usual_rates(labelled)).collect()
    # 0.5 symbols a word lie 25 spreads above the usual 0: the cutoff of 24 is the first that takes them.
    level = quality_rules.ERROR / len(quality_rules.BANDS)
    if exact_tail(good, 0, 0.05) > level:
        assert chosen == []
    elif exact_tail(good, odd, 0.05) > level:
        assert [row["cutoff"] for row in chosen] == [30.0]
    else:
        assert [(row["cutoff"], row["n_holdouts"], row["n_rejected"]) for row in chosen] == [(24.0, good, odd)]


def test_strata_are_certified_apart(spark):
    labelled = labelled_sample(spark, 200, 30, 0).unionByName(labelled_sample(spark, 40, 30, 0, stratum=1))
    chosen = quality_rules.choose_cutoffs(labelled, quality_rules.usual_rates(labelled)).collect()
    assert [(row["stratum"], row["cutoff"]) for row in chosen] == [(0, 24.0)]


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality long, toxic long")


def test_rules_keep_good_and_reject_bad(spark):
    rng = random.Random(3)
    noisy = lambda seed: " ".join(word + "#$%" for word in sentence(seed, 80).split())
    rows = [(k, sentence(k, rng.randint(60, 200)) if k % 4 else noisy(k)) for k in range(1_000)]
    labels = labels_of(spark, [(k, int(k % 4 > 0), 0) for k in range(500)] + [(None, 0, 0), (1, None, 0), (2, 7, 0)])
    judged = quality_rules.apply_rules(make_docs(spark, [*rows, *EDGE_ROWS]), labels)
    kept = {row["doc_id"]: row["kept"] for row in judged.where("doc_id is not null").collect() if row["doc_id"] > 20}
    assert all(kept[k] == (k % 4 > 0) for k in range(21, 1_000))
    assert judged.count() == 1_000 + len(EDGE_ROWS)


def test_without_labels_only_the_base_rules_reject(spark, edge_docs, no_docs):  # noqa: F811
    judged = quality_rules.apply_rules(edge_docs, labels_of(spark, [])).collect()
    assert len(judged) == len(EDGE_ROWS)
    assert all(row["kept"] != row["base_failed"] for row in judged)
    assert all(row["base_failed"] == (row["n_words"] < 50 or 2 * row["n_repeat_words"] > row["n_words"]) for row in judged)
    assert quality_rules.apply_rules(no_docs, labels_of(spark, [])).collect() == []


def test_no_python_in_the_native_plan(spark, edge_docs):  # noqa: F811
    judged = quality_rules.apply_rules(edge_docs, labels_of(spark, [(5, 1, 0)]))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    counts = quality_rules.text_counts(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan + counts)


# --- the registered queries -----------------------------------------------------


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op12_conversation_trie", "op13_quality_rules"])
def test_query_equals_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "labels", "conversations"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = connection.sql(queries.oracle_sql()[name])
    found = queries.queries()[name](spark, sf_dir).select(*expected.columns)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected.fetchall(), key=repr)
