"""Physical plans: one scan, pruned columns, pushed filters, no Python, cheap top-k."""

import pytest

from ticketmill import operators as ops
from ticketmill.plans import catalogue
from ticketmill.plans.job import enriched_tickets
from ticketmill.schema import ENRICHED_SCHEMA
from ticketmill.sources import read_records


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def records(spark, edge_records, tmp_path):
    edge_records.write.parquet(str(tmp_path / "topic"))
    return read_records(spark, str(tmp_path / "topic"))


@pytest.fixture
def table(spark, records, tmp_path):
    enriched_tickets(records).write.parquet(str(tmp_path / "table"))
    return spark.read.schema(ENRICHED_SCHEMA).parquet(str(tmp_path / "table"))


def test_ingest_has_no_exchange(records):
    for strict in (False, True):
        checked = ops.enrich_tickets(ops.checked_tickets(records))
        plan = plan_of(checked if strict else enriched_tickets(records))
        assert "Exchange" not in plan
        assert plan.count("FileScan") == 1
        assert plan.count("from_json") == 1
        wanted = "key:binary,value:binary,topic:string,partition:int,offset:bigint,timestamp:timestamp"
        assert f"ReadSchema: struct<{wanted if strict else 'value:binary,timestamp:timestamp'}>" in plan


def test_json_schema_is_pruned(records):
    plan = plan_of(ops.count_by(enriched_tickets(records), "priority"))
    assert plan.count("from_json(StructField(priority,StringType,true), cast") == 1


def test_windows_parse_once(records):
    plan = plan_of(ops.window_counts_by_type(enriched_tickets(records, parse_once=True)))
    assert plan.count("from_json") == 1
    assert plan.count("Exchange") == 1


def test_counts_on_the_table_read_only_their_columns(table):
    plan = plan_of(ops.window_counts_by_priority(table))
    assert "ReadSchema: struct<created_at:timestamp,priority:string>" in plan
    assert "PushedFilters: [IsNotNull(created_at)]" in plan
    assert "ReadSchema: struct<client_id:string>" in plan_of(ops.count_by_client(table))


def test_counts_combine_before_the_exchange(table):
    plan = plan_of(ops.count_by_client(table))
    assert plan.index("partial_count") > plan.index("Exchange")  # printed top down
    assert plan.count("Exchange") == 1


def test_top_clients_never_sorts_everything(table):
    plan = plan_of(ops.top_clients(table))
    assert "TakeOrderedAndProject(limit=10" in plan
    assert "Sort" not in plan and "rangepartitioning" not in plan


def test_rollup_is_one_scan_and_one_exchange(table):
    plan = plan_of(ops.rollup_counts(table))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_time_slices_reach_the_scan(spark, sf_dir):
    events = catalogue.read_events(spark, sf_dir)
    cuts = catalogue._time_cuts(events)
    plan = plan_of(catalogue._between(events, cuts, 1, 2))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


PLAIN = [name for name in catalogue.queries() if not name.startswith(("stream_", "sink_"))]


@pytest.mark.parametrize("name", PLAIN)
def test_no_python_in_plans(spark, sf_dir, name):
    plan = plan_of(catalogue.queries()[name](spark, sf_dir))
    assert "Python" not in plan and "CartesianProduct" not in plan
