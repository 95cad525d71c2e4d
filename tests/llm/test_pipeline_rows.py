"""The pipeline's stages on rows with odd columns, ids and copies, and the rows that a list names."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from llm_samples import EDGE_ROWS, sentence
from pyspark.sql import functions as F

import corpus_pipeline
from ticketmill.llm.named_rows import named_apart, whole_row

ODD_NAMES = ["__id", "__text", "__stays", "__secrets", "__clean", "row", "a.b", "found", "cell", "bits", "ti`ck", "score"]
SECRET = 'token = "0123456789abcdef0123456789abcdef01234567"'


def odd_docs(spark, rows):
    """Rows (doc_id, text) with every odd column holding its name and the row's number."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, nth int"
    frame = spark.createDataFrame(
        [(doc_id, text, "en", "s", len(text or ""), nth) for nth, (doc_id, text) in enumerate(rows)], schema
    ).repartition(3)
    odd = [F.concat(F.lit(name), F.col("nth").cast("string")).alias(name) for name in ODD_NAMES]
    return frame.select("*", *odd)


def extra_values(docs):
    """The odd columns of each row by its number."""
    at = docs.columns.index("nth")
    return {row[at]: tuple(row)[at + 1 :] for row in docs.collect()}


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_leave_odd_columns_alone(spark, sf_dir, name):
    rows = [*EDGE_ROWS, (70, sentence(70, 30) + " " + SECRET), (71, sentence(5, 200)), (72, sentence(5, 200) + " x")]
    rows += [(None, sentence(5, 200)), (None, "other " + sentence(1, 50))]
    docs = odd_docs(spark, rows)
    made = dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)
    if name == "best_fit_packing":
        assert Counter(row["doc_id"] for row in made.where("piece = 0").collect()) == Counter(row[0] for row in rows)
        return
    assert made.columns == docs.columns
    kept, before = extra_values(made), extra_values(docs)
    assert made.count() == len(kept) > 0
    assert all(before[nth] == values for nth, values in kept.items())


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_no_rows(spark, sf_dir, name):
    assert dict(corpus_pipeline.STAGES)[name](spark, odd_docs(spark, []), sf_dir).collect() == []


def test_secrets_are_replaced_and_nothing_else(spark, sf_dir):
    rows = [(k, sentence(k, 40)) for k in range(40)] + [(k, sentence(k, 40) + f" {SECRET} end") for k in range(40, 60)]
    made = corpus_pipeline.redact_secrets(spark, odd_docs(spark, [*rows, rows[41], (None, rows[42][1])]), sf_dir)
    for doc_id, text, n_chars in made.select("doc_id", "text", "n_chars").collect():
        if doc_id is None or doc_id >= 40:
            assert "0123456789abcdef" not in text and text.endswith(" end") and "[secret]" in text
        else:
            assert text == rows[doc_id][1]
        assert n_chars == len(text)
    assert made.count() == 62


def test_named_rows_meet_their_names(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(20)]), rng.choice([None, "", *"abcdef"])) for _ in range(400)]
    docs = odd_docs(spark, rows)
    keys = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.lit(5).alias("five")).distinct()
    named = keys.where("doc_id is null or doc_id % 3 = 0")
    others, met = named_apart(docs, named)
    found = met.where("found is not null")
    wanted = Counter(row for row in rows if row[0] is None or row[0] % 3 == 0)
    assert Counter(map(tuple, found.select("row.doc_id", "row.text").collect())) == wanted
    assert found.where("found.five = 5").count() == sum(wanted.values())
    left = others.union(met.where("found is null").select("row.*"))
    assert Counter(map(tuple, left.select("doc_id", "text").collect())) == Counter(rows) - wanted
    nobody, _ = named_apart(docs, named.limit(0))
    assert nobody.count() == len(rows)
    assert docs.select(whole_row(docs)).select("row.*").columns == docs.columns


def test_texts_of_unnamed_rows_are_not_shuffled(spark):
    docs = odd_docs(spark, [(k, sentence(k, 5)) for k in range(50)])
    named = docs.where("doc_id < 5").select("doc_id", F.xxhash64("text").alias("text_hash"))
    others, _ = named_apart(docs, named)
    plan = others._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
