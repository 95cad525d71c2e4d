import json

import pytest
from conftest import make_records, rows, utc
from pyspark.sql import functions as F

from ticketmill.operators import enrich_tickets, parse_tickets
from ticketmill.schema import ENRICHED_SCHEMA


def times(frame):
    return frame.withColumn("created_at", F.unix_micros("created_at"))


def micros(text):
    return round(utc(text).timestamp() * 1_000_000)


@pytest.mark.parametrize("parse_once", [False, True])
def test_every_record_stays(edge_records, parse_once):
    parsed = times(parse_tickets(edge_records, parse_once))
    found = rows(parsed.select("ticket_id", "created_at", "request_type", "priority"))
    assert found == [
        ("TK-1", micros("2026-01-01T00:00:30.000001"), "incident_technique", "high"),
        ("TK-2", micros("2026-01-01T00:04:59.999999"), "incident_technique", "low"),
        ("TK-3", micros("2026-01-01T00:05:00"), "facturation", "low"),
        ("TK-4", micros("2026-01-01T01:00:00"), "autre", "medium"),
        ("TK-5", None, "maintenance", "low"),
        (None, None, None, None),
        ("TK-7", None, None, None),
        ("TK-1", micros("2026-01-01T00:00:30.000001"), "incident_technique", "high"),
        (None, None, None, None),
    ]


def test_enriched_columns(edge_records):
    enriched = enrich_tickets(parse_tickets(edge_records))
    assert [(f.name, f.dataType) for f in enriched.schema] == [
        (f.name, f.dataType) for f in ENRICHED_SCHEMA
    ]
    assert not enriched.schema["assigned_team"].nullable


@pytest.mark.parametrize("parse_once", [False, True])
@pytest.mark.parametrize(
    ("payload", "request_text"),
    [
        ('{"request":"a","other":1}', "a"),
        ('{"request":12}', "12"),
        ('{"request":true}', "true"),
        ('{"request":{"x":1}}', '{"x":1}'),
        ('{"request":"a","request":"b"}', "b"),
        ('{"REQUEST":"a"}', None),
        ("null", None),
        ("[]", None),
        ('{"request":"a"', None),
        ("", None),
        (json.dumps({"request": "é" * 20_000}), "é" * 20_000),
    ],
)
def test_payload_forms(spark, payload, request_text, parse_once):
    parsed = parse_tickets(make_records(spark, [payload]), parse_once)
    assert rows(parsed.select("request")) == [(request_text,)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2026-02-21T14:30:00Z", "2026-02-21T14:30:00"),
        ("2026-02-21T14:30:00.123456Z", "2026-02-21T14:30:00.123456"),
        ("2026-02-21T14:30:00+05:30", "2026-02-21T09:00:00"),
        ("2026-02-21", "2026-02-21T00:00:00"),
        ("2026-02-30T00:00:00Z", None),
        ("garbage", None),
        ("", None),
    ],
)
def test_event_time(spark, text, expected):
    parsed = times(parse_tickets(make_records(spark, [json.dumps({"created_at": text})])))
    assert rows(parsed.select("created_at")) == [(micros(expected) if expected else None,)]
