"""Numbers over whole tables and per client, late tickets and open windows."""

import random
from collections import defaultdict
from datetime import timedelta

import pytest
from conftest import rows, utc
from pyspark.sql import functions as F

from ticketmill.operators import enrich_tickets, number_rows, number_within, rank_rows
from ticketmill.plans import catalogue
from ticketmill.sinks import ClientSequencer, LateTickets
from ticketmill.streaming import open_windows, start_batches, start_window_table, wait_for
from ticketmill.streaming.queries import ONCE

START = utc("2026-01-01T00:00:00")
SCHEMA = "ticket_id STRING, client_id STRING, created_at TIMESTAMP, request_type STRING, priority STRING"


def tickets_of(spark, data):
    """Enriched tickets of (ticket, client, minutes) with minutes null for no time."""
    full = [
        (ticket, client, None if minutes is None else START + timedelta(minutes=minutes), "autre", "low")
        for ticket, client, minutes in data
    ]
    return enrich_tickets(spark.createDataFrame(full, SCHEMA)).drop("processing_timestamp")


def drawn(seed, count, hot=0.4):
    rng = random.Random(seed)
    return [
        (f"TK-{at:05d}", "hot" if rng.random() < hot else rng.choice([None, *map(str, range(9))]), rng.choice([None, rng.uniform(0, 90)]))
        for at in range(count)
    ]


def in_time(data):
    return sorted(data, key=lambda one: (one[2] is not None, one[2] or 0, one[0]))


@pytest.mark.parametrize("count", [0, 1, 700])
def test_positions_follow_the_order(spark, tmp_path, count):
    data = drawn(1, count)
    order = [F.col("created_at"), F.col("ticket_id")]
    found = number_rows(tickets_of(spark, data).repartition(5), order, str(tmp_path / "all"))
    assert [row[0] for row in found.orderBy("position").select("ticket_id").collect()] == [one[0] for one in in_time(data)]
    assert sorted(row[0] for row in found.select("position").collect()) == list(range(count))
    ranked = rank_rows(tickets_of(spark, data), [F.desc("ticket_id")], str(tmp_path / "ranked"))
    assert {row.ticket_id: row["rank"] for row in ranked.collect()} == {
        f"TK-{at:05d}": count - at for at in range(count)
    }


def test_a_hot_key_is_numbered_in_several_ranges(spark, tmp_path):
    rows_ = spark.range(0, 40_000, 1, 8).select(F.lit("hot").alias("client_id"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = number_within(rows_, "client_id", [F.col("id")], str(tmp_path / "hot"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found.filter("position != id").count() == 0
    sizes = spark.read.parquet(str(tmp_path / "hot")).groupBy(F.shiftright("_place", 33)).count().collect()
    assert len(sizes) > 1 and max(size for _, size in sizes) < 30_000
    # No step of the plan is a window function in one task.
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()


def test_rows_are_computed_once(spark, tmp_path):
    """Also those of a task that has most of them, which the search for ranges reads once more."""
    computed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(number):
        computed.add(1)
        return f"c{number % 7}"

    numbers = spark.range(0, 20_000, 1, 1).union(spark.range(20_000, 20_010, 1, 5))
    rows_ = numbers.select(counted("id").alias("client_id"), "id")
    found = number_within(rows_, "client_id", [F.col("id")], str(tmp_path / "once"))
    assert computed.value == 20_010
    assert found.filter("position != id div 7").count() == 0 and found.count() == 20_010


def test_a_batch_is_computed_once_and_its_tickets_are_joined_once(spark, tmp_path, monkeypatch):
    computed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        computed.add(1)
        return text

    wide = []
    frame = type(spark.range(0))
    join = frame.join
    monkeypatch.setattr(frame, "join", lambda self, *of: wide.append("ticket_id" in self.columns) or join(self, *of))
    sequencer = ClientSequencer(str(tmp_path))
    for number in range(2):
        batch = tickets_of(spark, drawn(8 + number, 400)).withColumn("request_type", counted("request_type"))
        wide.clear()
        sequencer(batch, number)
        # One for the offsets of ranges, which are broadcast, and one for everything per client.
        assert sum(wide) == 2
        assert computed.value == 400 * (number + 1)


def test_arrived_events_are_dealt_out(spark, tmp_path):
    """A table in order of time in one row group gives the topic files of about one size."""
    start = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    events = spark.range(0, 3_000, 1, 1).select(
        F.col("id").alias("event_id"),
        (start + F.make_dt_interval(secs=F.col("id"))).alias("ts"),
        (F.col("id") % 9).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.lit('{"k": 3}').alias("props"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out, arrive = catalogue._arriving_in_parts(spark, str(tmp_path), "dealt")
        for part in range(catalogue.PARTS):
            arrive(part)
            topic = spark.read.parquet(f"{out}/topic")
            files = [row[0] for row in topic.groupBy(F.col("_metadata.file_name")).count().select("count").collect()]
            assert sum(files) == 1_000 * (part + 1)
            assert len(files) == 4 * (part + 1) and max(files) < 400
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_sequences_have_no_gaps_over_batches_and_retries(spark, tmp_path):
    batches = [drawn(seed, 150) for seed in (2, 3, 4, 5)]
    batches.insert(2, [])
    sequencer = ClientSequencer(str(tmp_path))
    wanted, had = {}, defaultdict(int)
    for number, data in enumerate(batches):
        batch = tickets_of(spark, [(f"{number}-{ticket}", client, minutes) for ticket, client, minutes in data])
        for _ in range(2 if number in (0, 3) else 1):  # a retried batch changes nothing
            sequencer(batch, number)
        for ticket, client, _ in in_time(data):
            had[client] += 1
            wanted[f"{number}-{ticket}"] = had[client]
        found = sequencer.read(spark, batch.schema)
        assert dict(rows(found.select("ticket_id", "sequence"))) == wanted
    numbers = defaultdict(list)
    for client, sequence in rows(found.select("client_id", "sequence")):
        numbers[client].append(sequence)
    assert all(sorted(own) == list(range(1, len(own) + 1)) for own in numbers.values())


def test_a_failed_batch_of_sequences_is_not_read(spark, tmp_path, monkeypatch):
    sequencer = ClientSequencer(str(tmp_path))
    first, second = (tickets_of(spark, drawn(seed, 30)) for seed in (6, 7))
    sequencer(first, 0)
    before = rows(sequencer.read(spark, first.schema))
    monkeypatch.setattr(sequencer.store, "add", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sequencer(second, 1)
    assert rows(sequencer.read(spark, first.schema)) == before


# Batches of (ticket, minutes), and which tickets the engine drops while batches follow
# each other at once. In runs of their own all four come too late.
LATE_BATCHES = [
    [("a", 0.5), ("b", 4)],
    [("c", 7), ("d", 3)],
    [("late1", 4.98), ("e", 12)],
    [("late2", 4.97), ("late3", 8), ("f", 13), ("untimed", None)],
    [("late4", 8.02), ("g", 30)],
]
LATE = {"late1": False, "late2": True, "late3": False, "late4": True}


def test_late_tickets_are_those_that_windows_drop(spark, tmp_path):
    sink = LateTickets(str(tmp_path / "late"))
    streamed = tmp_path / "tickets"
    for number, data in enumerate(LATE_BATCHES):
        batch = tickets_of(spark, [(ticket, "c", minutes) for ticket, minutes in data])
        batch.coalesce(1).write.mode("append").parquet(str(streamed))
        arrived = spark.readStream.schema(batch.schema).parquet(str(streamed))
        wait_for(
            start_batches(arrived, sink, str(tmp_path / "ck-late"), "late", ONCE),
            start_window_table(arrived, ["priority"], str(tmp_path / "windows"), str(tmp_path / "ck-windows"), "windows", ONCE),
        )
    late = {row.ticket_id for row in sink.read(spark, batch.schema).collect()}
    assert late == LATE.keys()
    closed = spark.read.parquet(str(tmp_path / "windows"))
    still_open = open_windows(spark, str(tmp_path / "ck-windows"), ["priority"])
    timed = sum(minutes is not None for data in LATE_BATCHES for _, minutes in data)
    total = closed.unionByName(still_open).agg(F.sum("ticket_count")).first()[0]
    assert total + len(late) == timed
    assert rows(still_open.select("window.start", "priority", "ticket_count")) == [
        (utc("2026-01-01T00:30:00").replace(tzinfo=None), "low", 1)
    ]


def test_lagging_rule_and_retried_batches(spark, tmp_path):
    sink = LateTickets(str(tmp_path), lag=1)
    batches = [tickets_of(spark, [(t, "c", m) for t, m in data]) for data in LATE_BATCHES]
    for number, batch in enumerate(batches):
        sink(batch, number)
        sink(batch, number)
    late = {row.ticket_id for row in sink.read(spark, batches[0].schema).collect()}
    assert late == {ticket for ticket, dropped in LATE.items() if dropped}
