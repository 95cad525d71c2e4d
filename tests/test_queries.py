"""Every registered query equals its SQL twin."""

import sys
from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from ticketmill.sources import read_events

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry_point  # noqa: E402

from ticketmill.plans import catalogue, oracle  # noqa: E402

QUERIES = catalogue.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{sf_dir}/events.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLE.keys() <= entry_point.oracle_sql().keys() <= entry_point.queries().keys()


@pytest.fixture(scope="module")
def odd_events(spark, tmp_path_factory):
    """Tables of events: some without a time, all without one, and none at all."""
    folder = tmp_path_factory.mktemp("odd")
    events = read_events(spark, SF_DIR).limit(300)
    untimed = events.withColumn("ts", F.when(F.col("event_id") % 9 != 0, F.col("ts")))
    tables = {"some": untimed, "all": events.withColumn("ts", F.lit(None).cast("timestamp_ntz")), "none": events.limit(0)}
    for name, table in tables.items():
        table.coalesce(1).write.parquet(str(folder / name / "events.parquet"))
    return folder


# Without any time, those that cut the events into parts by time or need a watermark.
UNTIMED = [
    "stream_late_data",
    "late_tickets",
    "open_windows",
    "client_sequence",
    "sink_cumulative_exports",
    "stream_restart_totals",
]


@pytest.mark.parametrize(
    "table, name",
    [(table, name) for table in ("some", "none") for name in QUERIES] + [("all", name) for name in UNTIMED],
)
def test_queries_on_odd_events(spark, odd_events, table, name):
    """Every query equals its SQL without event times and without events."""
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{odd_events}/{table}/events.parquet/*.parquet'")
    expected = connection.sql(ORACLE[name])
    found = QUERIES[name](spark, str(odd_events / table)).select(*expected.columns)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected.fetchall(), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    expected = duck.sql(ORACLE[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    ordered = expected.select(*[f'"{column}"' for column in columns])
    left = sorted((tuple(row) for row in found.select(*columns).collect()), key=repr)
    assert left == sorted(ordered.fetchall(), key=repr)
    assert left


def test_entry(spark, sf_dir):
    assert entry_point.entry(spark).count() == 6
