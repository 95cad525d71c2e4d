import json

import pytest
from conftest import M1, make_records, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ticketmill.operators import accepted_tickets, parse_tickets, rejected_records
from ticketmill.schema import TICKET_FIELDS


def test_split_is_complete(edge_records):
    accepted = [row[0] for row in rows(accepted_tickets(edge_records))]
    assert accepted == ["TK-1", "TK-2", "TK-3", "TK-4", "TK-1"]
    rejected = rows(rejected_records(edge_records).select("offset", "reject_reason", "value"))
    assert rejected[:3] == [
        (4, "bad_created_at", rejected[0][2]),
        (5, "no_ticket_fields", bytearray(b"not json")),
        (6, "missing_client_id", bytearray(b'{"ticket_id":"TK-7"}')),
    ]
    assert rejected[3:] == [(8, "null_value", None)]


def test_accepted_columns_match_parse(edge_records):
    assert accepted_tickets(edge_records).schema == parse_tickets(edge_records).schema


@pytest.mark.parametrize("field", TICKET_FIELDS)
def test_each_field_is_required(spark, field):
    fields = json.loads(M1)
    del fields[field]
    null = {**fields, field: None}
    records = make_records(spark, [json.dumps(fields), json.dumps(null)])
    assert rows(rejected_records(records).select("reject_reason")) == [(f"missing_{field}",)] * 2


@pytest.mark.parametrize(
    ("text", "valid"),
    [
        ("2026-02-21T14:30:00Z", True),
        ("2026-02-21T14:30:00.5Z", True),
        ("2026-02-21T14:30:00-03:00", True),
        ("2026-02-21", False),
        ("14:30", False),
        ("2026-02-21T14:30:00", False),
        ("2026-02-30T14:30:00Z", False),
        (" 2026-02-21T14:30:00Z", False),
        ("2026-02-21T14:30:00Z\n", False),
        ("2026-02-21 14:30:00Z", False),
    ],
)
def test_full_time_is_required(spark, text, valid):
    records = make_records(spark, [json.dumps({**json.loads(M1), "created_at": text})])
    assert accepted_tickets(records).count() == int(valid)
    expected = [] if valid else [("bad_created_at",)]
    assert rows(rejected_records(records).select("reject_reason")) == expected


field_value = st.one_of(st.none(), st.just("gone"), st.sampled_from(["", "x", "maintenance"]))
time_value = st.sampled_from(
    [None, "gone", "2026-01-01T00:00:00Z", "2026-13-01T00:00:00Z", "2026-01-01", "later"]
)
drawn_record = st.one_of(
    st.sampled_from([None, "", "{", "[1]", "{}"]),
    st.fixed_dictionaries(
        {name: time_value if name == "created_at" else field_value for name in TICKET_FIELDS}
    ),
)


def expected_reason(record):
    if record is None:
        return "null_value"
    if isinstance(record, str):
        return "no_ticket_fields"
    found = {name: None if value == "gone" else value for name, value in record.items()}
    if not any(value is not None for value in found.values()):
        return "no_ticket_fields"
    for name in TICKET_FIELDS:
        if found[name] is None:
            return f"missing_{name}"
    return None if found["created_at"] == "2026-01-01T00:00:00Z" else "bad_created_at"


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(drawn_record, min_size=1, max_size=40))
def test_reasons_against_brute_force(spark, drawn):
    payloads = [
        json.dumps({name: value for name, value in record.items() if value != "gone"})
        if isinstance(record, dict)
        else record
        for record in drawn
    ]
    records = make_records(spark, payloads)
    expected = [expected_reason(record) for record in drawn]
    rejected = rows(rejected_records(records).select("offset", "reject_reason"))
    assert rejected == [(i, reason) for i, reason in enumerate(expected) if reason]
    assert accepted_tickets(records).count() == expected.count(None)


TYPED = [
    (M1, None),
    (None, "null_value"),
    ("not json", "no_ticket_fields"),
    ("", "no_ticket_fields"),
    ("null", "no_ticket_fields"),
    ("[1]", "no_ticket_fields"),
    ('"text"', "no_ticket_fields"),
    ("{}", "no_ticket_fields"),
    ('{"other": 1}', "no_ticket_fields"),
    ('{"ticket_id": null}', "no_ticket_fields"),
    ('{"ticket_id": "TK-7"}', "missing_client_id"),
    ('{"ticket_id": 7}', "wrong_type_ticket_id"),
    (M1[:-1], "no_ticket_fields"),
]


def changed(**fields):
    return json.dumps({**json.loads(M1), **fields})


TYPED += [(changed(**{field: value}), f"wrong_type_{field}") for field in TICKET_FIELDS for value in (5, 0.5, True, {"a": 1}, ["x"])]
TYPED += [
    (changed(priority=None), "missing_priority"),
    (changed(extra="x"), "unknown_field"),
    (changed(extra=None), "unknown_field"),
    (changed(Priority="x"), "unknown_field"),
    (changed(created_at="not a date"), "bad_created_at"),
    (changed(created_at="2026-02-21"), "bad_created_at"),
    (changed(request=""), None),
]


def test_typed_reasons(spark):
    records = make_records(spark, [value for value, _ in TYPED])
    found = dict(rows(rejected_records(records, typed=True).select("offset", "reject_reason")))
    assert found == {at: reason for at, (_, reason) in enumerate(TYPED) if reason}
    accepted = accepted_tickets(records, typed=True)
    assert accepted.schema == accepted_tickets(records).schema
    assert [row[0] for row in rows(accepted)] == [json.loads(M1)["ticket_id"]] * 2
    assert rows(accepted.limit(1)) == rows(accepted_tickets(make_records(spark, [M1])))


def test_types_are_read_in_one_parse(edge_records):
    plan = rejected_records(edge_records, typed=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.lower().count("parsejson") == 1, plan
    assert "from_json" not in plan
