"""The whole job over replayed records, and the Kafka adapter's options."""

import os
from dataclasses import replace

import pytest
from conftest import EDGE_VALUES, make_records, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ticketmill.operators import row_count
from ticketmill.plans import job
from ticketmill.plans.job import JobConfig, catch_up, checkpoint_root, start_job
from ticketmill.schema import ENRICHED_SCHEMA
from ticketmill.sinks import LostCheckpointError, latest_counts, read_export
from ticketmill.sources import (
    publish_to_kafka,
    read_accepted,
    read_enriched,
    read_rejected,
    start_kafka_publish,
    stream_kafka,
    stream_records,
)
from ticketmill.streaming import wait_for
from ticketmill.streaming.queries import ONCE, PRIORITY_KEYS

NAMES = ["enriched_tickets", "tickets_by_type", "tickets_by_priority", "batch_aggregations"]
SOON = {"processingTime": "100 milliseconds"}


@pytest.fixture
def topic(spark, tmp_path):
    path = str(tmp_path / "topic")
    make_records(spark, EDGE_VALUES).coalesce(1).write.parquet(path)
    return path


def config(tmp_path, **options):
    return JobConfig(
        output_path=str(tmp_path / "out"), checkpoint_path=str(tmp_path / "checkpoints"), **options
    )


def counts_of(frame, *keys):
    return dict(rows(frame.groupBy(*keys).agg(F.sum("ticket_count"))))


def test_four_queries_over_one_stream(spark, topic, tmp_path):
    setup = config(tmp_path, fan_out="source", ingest_trigger=ONCE, export_trigger=ONCE)
    queries = start_job(spark, stream_records(spark, topic), setup)
    assert [query.name for query in queries] == NAMES
    wait_for(*queries)
    out = setup.output_path
    assert rows(row_count(spark.read.parquet(f"{out}/enriched_tickets"))) == [(9,)]
    windows = latest_counts(spark, f"{out}/tickets_by_priority", *PRIORITY_KEYS)
    assert counts_of(windows, "priority") == {"high": 2, "low": 2, "medium": 1}
    assert dict(rows(read_export(spark, out, "agg_by_priority"))) == {
        None: 3, "low": 3, "high": 2, "medium": 1,
    }
    assert sorted(os.listdir(setup.checkpoint_path)) == sorted(NAMES)


def test_counting_queries_follow_the_enriched_table(spark, topic, tmp_path):
    setup = config(
        tmp_path, ingest_trigger=SOON, export_trigger=SOON, export_mode="cumulative"
    )
    queries = start_job(spark, stream_records(spark, topic), setup)
    try:
        for _ in range(2):
            for query in queries:
                query.processAllAvailable()
            assert all(query.isActive for query in queries)
            make_records(spark, EDGE_VALUES[:3]).coalesce(1).write.mode("append").parquet(topic)
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    out = setup.output_path
    assert rows(row_count(spark.read.parquet(f"{out}/enriched_tickets"))) == [(15,)]
    assert dict(rows(read_export(spark, out, "json_by_priority"))) == {
        None: 3, "low": 7, "high": 4, "medium": 1,
    }


def test_catch_up_continues_where_it_ended(spark, topic, tmp_path):
    setup = config(tmp_path, export_mode="cumulative")
    for expected in ({None: 3, "low": 3, "high": 2, "medium": 1},) * 2:
        catch_up(spark, stream_records(spark, topic), setup)
        assert dict(rows(read_export(spark, setup.output_path, "agg_by_priority"))) == expected
    make_records(spark, EDGE_VALUES[:3]).coalesce(1).write.mode("append").parquet(topic)
    catch_up(spark, stream_records(spark, topic), setup)
    assert dict(rows(read_export(spark, setup.output_path, "agg_by_priority"))) == {
        None: 3, "low": 5, "high": 3, "medium": 1,
    }
    table = spark.read.parquet(f"{setup.output_path}/enriched_tickets")
    assert rows(row_count(table)) == [(12,)]


@pytest.mark.parametrize("fan_out", ["source", "table"])
def test_strict_job_separates_rejects(spark, topic, tmp_path, fan_out):
    setup = config(tmp_path, strict=True, fan_out=fan_out, windows="append")
    catch_up(spark, stream_records(spark, topic), setup)
    out = setup.output_path
    accepted = read_accepted(spark, f"{out}/checked_records")
    assert rows(row_count(accepted)) == [(5,)]
    assert accepted.columns == [*ENRICHED_SCHEMA.names, "ingest_day"]
    rejects = read_rejected(spark, f"{out}/checked_records")
    payloads = dict(rows(rejects.select("offset", F.col("value").cast("string"))))
    assert payloads == {number: EDGE_VALUES[number] for number in (4, 5, 6, 8)}
    assert sorted(rows(rejects.select("offset", "reject_reason"))) == [
        (4, "bad_created_at"), (5, "no_ticket_fields"),
        (6, "missing_client_id"), (8, "null_value"),
    ]
    assert dict(rows(read_export(spark, out, "agg_by_priority"))) == {
        "high": 2, "low": 2, "medium": 1,
    }
    closed = spark.read.parquet(f"{out}/tickets_by_priority")
    assert counts_of(closed, "priority") == {"high": 2, "low": 2}


TARGETS = {
    "enriched_tickets": {},
    "checked_records": {"strict": True},
    "tickets_by_type": {},
    "tickets_by_priority": {"windows": "append"},
    "batch_aggregations": {},
    "batch_aggregations ": {"export_mode": "cumulative"},
}


@pytest.mark.parametrize("name", TARGETS)
@pytest.mark.parametrize("how", ["lost", "replaced"])
def test_lost_checkpoint_is_refused_before_anything_is_written(spark, topic, tmp_path, name, how):
    setup, name = config(tmp_path, **TARGETS[name]), name.strip()
    catch_up(spark, stream_records(spark, topic), setup)
    make_records(spark, EDGE_VALUES[:3]).coalesce(1).write.mode("append").parquet(topic)
    os.rename(tmp_path / "checkpoints" / name, tmp_path / "gone")
    if how == "replaced":
        other = config(tmp_path / "other", **TARGETS.get(f"{name} ", TARGETS[name]))
        catch_up(spark, stream_records(spark, topic), other)
        os.rename(tmp_path / "other" / "checkpoints" / name, tmp_path / "checkpoints" / name)
    target = tmp_path / "out" if name == "batch_aggregations" else tmp_path / "out" / name

    def files():
        return {str(path): path.stat().st_mtime_ns for path in target.rglob("*") if path.is_file()}

    if name == "batch_aggregations":  # the windows before it may go on
        windows = ("enriched_tickets", "checked_records", "tickets_by")
        kept = lambda: {path: time for path, time in files().items() if not any(w in path for w in windows)}
    else:
        kept = files
    before = kept()
    with pytest.raises(LostCheckpointError):
        catch_up(spark, stream_records(spark, topic), setup)
    for query in spark.streams.active:
        query.stop()
    assert kept() == before


def test_reading_one_ingest_day_prunes_the_others(spark, topic, tmp_path):
    setup = config(tmp_path)
    catch_up(spark, stream_records(spark, topic), setup)
    table = read_enriched(spark, f"{setup.output_path}/enriched_tickets")
    day = table.agg(F.max("ingest_day")).first()[0]
    one = table.filter(F.col("ingest_day") == day).select("ticket_id")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_day" in plan and one.count() == 9


def test_late_start_works_through_the_table_in_micro_batches(spark, topic, tmp_path):
    setup = config(tmp_path, max_files_per_trigger=1)
    for day in range(2, 7):
        if day > 2:  # the fixture's own records are of the first day
            values = [value and value.replace("2026-01-01", f"2026-01-{day:02d}") for value in EDGE_VALUES]
            make_records(spark, values).coalesce(1).write.mode("append").parquet(topic)
        job.wait_for(*job.start_ingest(spark, stream_records(spark, topic), once(setup)))
    job.wait_for(*job.start_counting(spark, None, once(setup)))
    out = setup.output_path
    windows = latest_counts(spark, f"{out}/tickets_by_priority", *PRIORITY_KEYS)
    assert counts_of(windows, "priority") == {"high": 10, "low": 10, "medium": 5}
    batches = os.listdir(tmp_path / "checkpoints" / "tickets_by_priority" / "commits")
    assert len([name for name in batches if name.isdigit()]) >= 4


def once(setup):
    return replace(setup, ingest_trigger=ONCE, export_trigger=ONCE)


def test_failed_query_raises(spark, topic, tmp_path):
    broken = stream_records(spark, topic).withColumn(
        "value", F.raise_error(F.lit("broken record")).cast("binary")
    )
    queries = start_job(
        spark, broken, config(tmp_path, fan_out="source", ingest_trigger=ONCE, export_trigger=ONCE)
    )
    with pytest.raises(Exception, match="broken record"):
        wait_for(*queries)
    assert not any(query.isActive for query in queries)


def test_run_ends_with_the_error_of_a_failed_query(spark, topic, tmp_path, monkeypatch):
    def broken_topic(session, servers, name, **options):
        assert (session, servers, name) == (spark, "localhost:9092", "client_tickets")
        assert options == {
            "fail_on_data_loss": True,
            "max_offsets_per_trigger": None,
            "min_partitions": None,
        }
        failing = F.raise_error(F.lit("broken record")).cast("binary")
        return stream_records(session, topic).withColumn("value", failing)

    monkeypatch.setattr(job, "stream_kafka", broken_topic)
    with pytest.raises(Exception, match="broken record"):
        job.run(config(tmp_path, ingest_trigger=SOON, export_trigger=SOON), spark)
    assert not spark.streams.active


def test_triggers_are_those_of_the_contract(tmp_path):
    setup = config(tmp_path)
    assert setup.ingest_trigger == {"processingTime": "30 seconds"}
    assert setup.export_trigger == {"processingTime": "60 seconds"}


def test_checkpoints_default_to_the_shared_folder(spark, monkeypatch):
    setup = JobConfig("out")
    monkeypatch.setattr(job, "shared_folder", lambda session: "/shared")
    assert checkpoint_root(spark, setup) == "/shared/ticketmill/client_tickets"


def test_config_from_environment(spark):
    default = JobConfig.from_env({})
    assert (default.servers, default.topic) == ("localhost:9092", "client_tickets")
    assert (default.fail_on_data_loss, default.export_mode) == (True, "last_batch")
    changed = JobConfig.from_env(
        {
            "KAFKA_BROKER": "b:1",
            "TOPIC_NAME": "t",
            "OUTPUT_PATH": "/o",
            "CHECKPOINT_PATH": "/c/",
            "STRICT": "true",
            "EXPORT_MODE": "cumulative",
            "MAX_OFFSETS_PER_TRIGGER": "1000",
            "MIN_PARTITIONS": "64",
            "STATE_PARTITIONS": "",
            "MAX_FILES_PER_TRIGGER": "8",
            "TABLE_RETENTION": "90d",
        }
    )
    assert (changed.servers, changed.topic, changed.output_path) == ("b:1", "t", "/o")
    assert (changed.strict, changed.export_mode) == (True, "cumulative")
    assert changed.max_offsets_per_trigger == 1000
    assert (changed.min_partitions, changed.state_partitions) == (64, None)
    assert (changed.max_files_per_trigger, changed.table_retention) == (8, "90d")
    assert checkpoint_root(spark, changed) == "/c"
    with pytest.raises(ValueError):
        JobConfig("/o", fan_out="other")
    with pytest.raises(ValueError):
        JobConfig("/o", windows="complete")


class Recorder:
    """Stands in for a reader or writer and notes what it is told."""

    def __init__(self):
        self.options = {}

    def __getattr__(self, name):
        def note(*args, **settings):
            if name == "option":
                self.options[args[0]] = args[1]
            else:
                self.options[name] = args or settings
            return self

        return note


def test_kafka_source_options():
    class Session:
        readStream = Recorder()

    stream_kafka(Session, "b:1", "t", max_offsets_per_trigger=5, min_partitions=9)
    assert Session.readStream.options == {
        "format": ("kafka",),
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": "5",
        "minPartitions": "9",
        "load": {},
    }


def test_kafka_sink_options():
    class Records:
        write = Recorder()
        writeStream = Recorder()

        def select(self, *columns):
            assert columns == ("key", "value")
            return self

    publish_to_kafka(Records(), "b:1", "t")
    assert Records.write.options["kafka.acks"] == "all"
    assert Records.write.options["topic"] == "t"
    start_kafka_publish(Records(), "b:1", "/checkpoint", "t")
    assert Records.writeStream.options == {
        "queryName": ("publish_t",),
        "format": ("kafka",),
        "kafka.bootstrap.servers": "b:1",
        "kafka.acks": "all",
        "topic": "t",
        "checkpointLocation": "/checkpoint",
        "trigger": {"processingTime": "1 second"},
        "start": {},
    }


def test_missing_connector_is_reported(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        stream_kafka(spark, "localhost:9092")
