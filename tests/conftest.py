from __future__ import annotations

import json
import os
import tempfile
from datetime import datetime, timezone

import pytest
from pyspark.sql import DataFrame, SparkSession

from ticketmill.schema import RECORD_SCHEMA, TOPIC
from ticketmill.session import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = build_session(
        "ticketmill-tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture(scope="session")
def sf_dir() -> str:
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables are not here")
    return SF_DIR


def ticket(ticket_id, client_id, created_at, request_type, priority, request="aide é"):
    return json.dumps(
        {
            "ticket_id": ticket_id,
            "client_id": client_id,
            "created_at": created_at,
            "request": request,
            "request_type": request_type,
            "priority": priority,
        },
        ensure_ascii=False,
    )


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def make_records(spark: SparkSession, values: list[str | None]) -> DataFrame:
    """Topic records with the given payloads, at consecutive offsets."""
    rows = [
        (
            b"key",
            None if value is None else bytearray(value.encode()),
            TOPIC,
            0,
            offset,
            utc("2026-01-01T00:00:00"),
            0,
        )
        for offset, value in enumerate(values)
    ]
    return spark.createDataFrame(rows, RECORD_SCHEMA)


M1 = ticket("TK-1", "CLI-0001", "2026-01-01T00:00:30.000001Z", "incident_technique", "high")

# Edge records M1 to M9: valid, window edges, offset, bad time, not JSON, one field
# only, an exact copy of M1, and no value at all.
EDGE_VALUES = [
    M1,
    ticket("TK-2", "CLI-0001", "2026-01-01T00:04:59.999999Z", "incident_technique", "low"),
    ticket("TK-3", "CLI-0002", "2026-01-01T00:05:00Z", "facturation", "low"),
    ticket("TK-4", "CLI-0002", "2026-01-01T02:00:00+01:00", "autre", "medium"),
    ticket("TK-5", "CLI-0003", "not a date", "maintenance", "low"),
    "not json",
    '{"ticket_id":"TK-7"}',
    M1,
    None,
]


@pytest.fixture(scope="session")
def edge_records(spark) -> DataFrame:
    return make_records(spark, EDGE_VALUES)


def rows(frame: DataFrame) -> list[tuple]:
    return [tuple(row) for row in frame.collect()]


def row_set(frame: DataFrame) -> set[tuple]:
    collected = rows(frame)
    assert len(set(collected)) == len(collected)
    return set(collected)
