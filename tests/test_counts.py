from collections import Counter

import pytest
from conftest import row_set, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketmill import operators as ops
from ticketmill.operators.counts import ROLLUP_KEYS


@pytest.fixture(scope="module")
def tickets(edge_records):
    return ops.enrich_tickets(ops.parse_tickets(edge_records))


def test_by_type(tickets):
    assert rows(ops.count_by_type(tickets)) == [
        (None, "Support General", 3),
        ("incident_technique", "Equipe Infrastructure", 3),
        ("autre", "Support General", 1),
        ("facturation", "Service Comptabilite", 1),
        ("maintenance", "Equipe Operations", 1),
    ]


def test_by_priority(tickets):
    assert rows(ops.count_by_priority(tickets)) == [
        (None, 3),
        ("low", 3),
        ("high", 2),
        ("medium", 1),
    ]


def test_by_hour(tickets):
    assert rows(ops.count_by_hour(tickets)) == [(None, 4), (0, 4), (1, 1)]


def test_by_client(tickets):
    assert row_set(ops.count_by_client(tickets)) == {
        ("CLI-0001", 3),
        (None, 3),
        ("CLI-0002", 2),
        ("CLI-0003", 1),
    }


def test_top_clients_breaks_ties_by_id(spark):
    clients = [f"CLI-{i:04d}" for i in range(30) for _ in range(1 + (i == 7))]
    frame = spark.createDataFrame([(c,) for c in clients], "client_id STRING").repartition(5)
    expected = [("CLI-0007", 2)] + [(f"CLI-{i:04d}", 1) for i in range(10) if i != 7]
    assert rows(ops.top_clients(frame)) == expected
    assert rows(ops.top_clients(frame, 3)) == expected[:3]


def test_row_count(tickets):
    assert rows(ops.row_count(tickets)) == [(9,)]


def test_windows(tickets):
    found = ops.window_counts_by_type(tickets).select(
        F.date_format("window.start", "HH:mm"), F.date_format("window.end", "HH:mm"),
        "request_type", "ticket_count",
    )
    assert row_set(found) == {
        ("00:00", "00:05", "incident_technique", 3),
        ("00:05", "00:10", "facturation", 1),
        ("01:00", "01:05", "autre", 1),
    }
    by_priority = ops.window_counts_by_priority(tickets).select("priority", "ticket_count")
    assert Counter(rows(by_priority)) == Counter(
        [("high", 2), ("low", 1), ("low", 1), ("medium", 1)]
    )


def test_window_before_epoch_is_aligned(spark):
    last_moment = "TIMESTAMP'1969-12-31 23:59:59.999999'"
    frame = spark.sql(f"SELECT {last_moment} AS created_at, 'low' AS priority")
    found = ops.window_counts_by_priority(frame).select(
        F.date_format("window.start", "yyyy-MM-dd HH:mm:ss")
    )
    assert rows(found) == [("1969-12-31 23:55:00",)]


def test_rollup_equals_single_counts(tickets):
    rollup = ops.rollup_counts(tickets).cache()
    singles = {
        "by_type": ops.count_by_type(tickets),
        "by_priority": ops.count_by_priority(tickets),
        "by_hour": ops.count_by_hour(tickets),
        "by_client": ops.count_by_client(tickets),
    }
    for name, keys in ROLLUP_KEYS.items():
        part = rollup.filter(F.col("target") == name).select(*keys, "ticket_count")
        assert row_set(part) == row_set(singles[name])
    rollup.unpersist()


text = st.one_of(st.none(), st.sampled_from(["a", "b", "A", "", "é"]))


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.tuples(text, text, text, text, st.integers(0, 200_000)), max_size=40))
def test_rollup_against_brute_force(spark, drawn):
    frame = spark.createDataFrame(
        drawn, "request_type STRING, assigned_team STRING, priority STRING, client_id STRING, s INT"
    ).withColumn("created_at", F.timestamp_seconds("s"))
    expected = Counter()
    for kind, team, priority, client, second in drawn:
        expected["by_type", kind, team, None, None, None] += 1
        expected["by_priority", None, None, priority, None, None] += 1
        expected["by_hour", None, None, None, second // 3600 % 24, None] += 1
        expected["by_client", None, None, None, None, client] += 1
    found = rows(ops.rollup_counts(frame))
    assert {row[:6]: row[6] for row in found} == dict(expected)
    assert len(found) == len(expected)
