"""Streaming queries against their batch forms, late data and restarts."""

import os
import random
from collections import Counter
from datetime import date, datetime, timedelta, timezone

import pytest
from conftest import row_set, rows, utc
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ticketmill import operators as ops
from ticketmill.plans.job import enriched_tickets
from ticketmill.sinks import (
    BatchExporter,
    change_writer,
    compact_changes,
    latest_counts,
    read_changes,
    read_export,
)
from ticketmill.sinks.changes import FILES_PER_DAY
from ticketmill.sources import event_records, read_events, read_records, stream_records
from ticketmill.streaming import (
    start_enriched_table,
    start_exports,
    start_window_changes,
    start_window_table,
    wait_for,
)
from ticketmill.streaming.queries import ONCE, PRIORITY_KEYS, TYPE_KEYS

DAY = "2026-01-01T"

# Six micro-batches are made of these files (times on one day) plus an empty one.
LATE_FILES = [
    ["00:00:30", "00:04:00"],
    ["00:07:00", "00:03:00"],
    ["00:04:59", "00:12:00"],
    ["00:04:58", "00:08:00", "00:13:00", None],
    ["00:08:01", "00:30:00"],
]


def batch_files(spark, folder, batches):
    """One file of times per micro-batch, in a fixed order of modification times."""
    for number, times in enumerate(batches):
        frame = spark.createDataFrame([(time,) for time in times], "created_at TIMESTAMP")
        frame.coalesce(1).write.parquet(str(folder / f"write-{number}"))
        (part,) = (folder / f"write-{number}").glob("part-*.parquet")
        target = folder / "in" / f"batch-{number}.parquet"
        target.parent.mkdir(exist_ok=True)
        os.link(part, target)
        os.utime(target, (1_700_000_000 + number, 1_700_000_000 + number))
    return str(folder / "in")


@pytest.fixture(scope="module")
def late_files(spark, tmp_path_factory):
    batches = [[utc(DAY + time) if time else None for time in times] for times in LATE_FILES]
    return batch_files(spark, tmp_path_factory.mktemp("late"), batches)


def late_stream(spark, path):
    return (
        spark.readStream.schema("created_at TIMESTAMP")
        .option("maxFilesPerTrigger", "1")
        .parquet(path)
    )


def window_start():
    return F.date_format("window.start", "HH:mm")


def test_late_data_in_update_mode(spark, late_files, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    wait_for(
        start_window_changes(late_stream(spark, late_files), [], out, checkpoint, "late", ONCE)
    )
    log = spark.read.parquet(out).select("batch_id", window_start(), "ticket_count")
    assert row_set(log) == {
        (0, "00:00", 2),
        (1, "00:00", 3),
        (1, "00:05", 1),
        (2, "00:00", 4),
        (2, "00:10", 1),
        (3, "00:05", 2),
        (3, "00:10", 2),
        (4, "00:30", 1),
    }
    sizes = log.groupBy("batch_id").count()
    assert sizes.count() == 5  # the last micro-batch has no data and changes nothing
    latest = latest_counts(spark, out).select(window_start(), "ticket_count")
    assert row_set(latest) == {("00:00", 4), ("00:05", 2), ("00:10", 2), ("00:30", 1)}


def test_late_data_in_append_mode(spark, late_files, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    wait_for(start_window_table(late_stream(spark, late_files), [], out, checkpoint, "late", ONCE))
    closed = spark.read.parquet(out).select(window_start(), "ticket_count")
    assert row_set(closed) == {("00:00", 4), ("00:05", 2), ("00:10", 2)}


def counted_windows(batches):
    """The late-data rule in plain Python: counts per window, and the final watermark.

    A micro-batch drops a time whose window was closed by the watermark of the
    micro-batch before it, which knows the times of still earlier ones.
    """
    counts, watermark, previous = Counter(), None, None
    newest = None
    for times in batches:
        for time in times:
            start = datetime.fromtimestamp(time.timestamp() // 300 * 300, timezone.utc)
            if previous is None or start + timedelta(minutes=5) > previous:
                counts[start.strftime("%H:%M")] += 1
        previous = watermark
        newest = max([newest, *times] if newest else times)
        watermark = newest - timedelta(minutes=1)
    return counts, watermark


@pytest.mark.parametrize("seed", range(3))
def test_random_late_data(spark, tmp_path, seed):
    draw = random.Random(seed)
    base = utc(DAY + "06:00:00")
    batches = [
        [base + timedelta(seconds=240 * i + draw.gauss(0, 300)) for _ in range(40)]
        for i in range(4, 11)
    ]
    source = batch_files(spark, tmp_path, batches)
    expected, watermark = counted_windows(batches)
    assert sum(expected.values()) < 7 * 40  # some are dropped

    changes, table = str(tmp_path / "changes"), str(tmp_path / "table")
    stream = late_stream(spark, source)
    wait_for(
        start_window_changes(stream, [], changes, str(tmp_path / "c1"), "late_update", ONCE),
        start_window_table(stream, [], table, str(tmp_path / "c2"), "late_append", ONCE),
    )
    latest = latest_counts(spark, changes).select(window_start(), "ticket_count")
    assert dict(rows(latest)) == dict(expected)
    closed = spark.read.parquet(table).select(window_start(), "ticket_count")
    limit = (watermark - timedelta(minutes=5)).strftime("%H:%M:%S.%f")
    assert dict(rows(closed)) == {
        start: n for start, n in expected.items() if f"{start}:00.000000" <= limit
    }


def test_complete_mode_drops_nothing(spark, late_files, tmp_path):
    seen = {}

    def keep(counts, batch_id):
        seen[batch_id] = row_set(counts.select(window_start(), "ticket_count"))

    counts = ops.window_counts(late_stream(spark, late_files))
    query = counts.writeStream.outputMode("complete").foreachBatch(keep)
    query = query.option("checkpointLocation", str(tmp_path / "c")).trigger(**ONCE).start()
    wait_for(query)
    assert seen[4] == {("00:00", 5), ("00:05", 3), ("00:10", 2), ("00:30", 1)}


@pytest.fixture(scope="module")
def topic(spark, sf_dir, tmp_path_factory):
    """The derived records in six files, in time order."""
    folder = tmp_path_factory.mktemp("topic")
    records = event_records(read_events(spark, sf_dir))
    for number in range(6):
        part = records.filter(F.floor(F.col("offset") * 6 / 1000) == number)
        part.coalesce(1).write.mode("append").parquet(str(folder / "data"))
        written = set((folder / "data").glob("part-*.parquet"))
        newest = max(written, key=lambda path: path.stat().st_mtime_ns)
        os.utime(newest, (1_700_000_000 + number, 1_700_000_000 + number))
    return str(folder / "data")


def in_time_order(spark, topic):
    return enriched_tickets(stream_records(spark, topic, max_files_per_trigger=1))


def text_counts(frame, keys):
    return row_set(
        frame.select(F.date_format("window.start", "yyyy-MM-dd HH:mm"), *keys, "ticket_count")
    )


@pytest.mark.parametrize("keys", [TYPE_KEYS, PRIORITY_KEYS])
def test_append_equals_batch_over_closed_windows(spark, topic, tmp_path, keys):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    stream = in_time_order(spark, topic)
    wait_for(start_window_table(stream, keys, out, checkpoint, "append", ONCE))
    tickets = enriched_tickets(read_records(spark, topic))
    newest = tickets.agg(F.max("created_at")).first()[0]
    closed = F.col("window.end") <= F.lit(newest) - F.expr("INTERVAL 1 MINUTE")
    expected = ops.window_counts(tickets, *keys).filter(closed)
    assert text_counts(spark.read.parquet(out), keys) == text_counts(expected, keys)


@pytest.mark.parametrize("keys", [TYPE_KEYS, PRIORITY_KEYS])
def test_update_log_ends_at_batch_counts(spark, topic, tmp_path, keys):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    stream = in_time_order(spark, topic)
    wait_for(start_window_changes(stream, keys, out, checkpoint, "update", ONCE))
    assert spark.read.parquet(out).select("batch_id").distinct().count() >= 6
    expected = ops.window_counts(enriched_tickets(read_records(spark, topic)), *keys)
    assert text_counts(latest_counts(spark, out, *keys), keys) == text_counts(expected, keys)


def test_enriched_table_and_restart(spark, topic, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        wait_for(start_enriched_table(in_time_order(spark, topic), out, checkpoint, ONCE))
        return sorted(
            rows(spark.read.parquet(out).select("ticket_id", "assigned_team")), key=str
        )

    first = run()
    expected = enriched_tickets(read_records(spark, topic)).select("ticket_id", "assigned_team")
    assert first == sorted(rows(expected), key=str)
    assert len(os.listdir(tmp_path / "out" / "_spark_metadata")) >= 6
    assert run() == first  # the same checkpoint adds nothing


def test_windows_continue_after_restart(spark, topic, tmp_path):
    """State survives: a run per file ends like one run over all files."""
    source = tmp_path / "in"
    source.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for path in sorted(os.scandir(topic), key=lambda entry: entry.stat().st_mtime):
        if not path.name.startswith("part-"):
            continue
        os.link(path.path, source / path.name)
        stream = enriched_tickets(stream_records(spark, str(source)))
        wait_for(start_window_changes(stream, PRIORITY_KEYS, out, checkpoint, "again", ONCE))
    expected = ops.window_counts(enriched_tickets(read_records(spark, topic)), *PRIORITY_KEYS)
    latest = latest_counts(spark, out, *PRIORITY_KEYS)
    assert text_counts(latest, PRIORITY_KEYS) == text_counts(expected, PRIORITY_KEYS)


def test_state_partitions_are_bounded_and_restored(spark, topic, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    query = start_window_table(
        in_time_order(spark, topic),
        PRIORITY_KEYS,
        str(tmp_path / "out"),
        str(tmp_path / "checkpoint"),
        "sized",
        ONCE,
        partitions=2,
    )
    wait_for(query)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert len(os.listdir(tmp_path / "checkpoint" / "state" / "0")) == 2 + 1  # and _metadata


def test_change_log_by_day(spark, tmp_path):
    """A retried batch replaces its own entries, and only wanted days are read."""
    out = str(tmp_path / "out")
    write = change_writer(out)

    def changed(counts):
        return spark.createDataFrame(
            [((utc(start), utc(start)), "low", n) for start, n in counts],
            "window STRUCT<start: TIMESTAMP, end: TIMESTAMP>, priority STRING, ticket_count BIGINT",
        )

    late, early = "2026-01-01T23:55:00", "2026-01-02T00:00:00"
    write(changed([(late, 1), (early, 5)]), 0)
    write(changed([(late, 2)]), 1)
    write(changed([(late, 2)]), 1)
    write(changed([]), 2)
    assert read_changes(spark, out, "priority").count() == 3

    def latest(**days):
        found = latest_counts(spark, out, "priority", **days)
        return found, sorted(rows(found.select(window_start(), "ticket_count")))

    assert latest()[1] == [("00:00", 5), ("23:55", 2)]
    found, counts = latest(first_day=date(2026, 1, 2))
    assert counts == [("00:00", 5)]
    assert len(found.inputFiles()) == 3  # listed; the plan reads one folder
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert latest(last_day=date(2026, 1, 1))[1] == [("23:55", 2)]


def test_change_log_adds_few_files(spark, topic, tmp_path):
    """A bounded number of files per day and micro-batch, also for a backlog."""
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    stream = enriched_tickets(stream_records(spark, topic))
    wait_for(start_window_changes(stream, TYPE_KEYS, out, checkpoint, "days", ONCE))
    folders = (tmp_path / "out").glob("day=*/batch_id=*")
    files = [len(list(folder.glob("part-*.parquet"))) for folder in folders]
    assert 1 < max(files) <= FILES_PER_DAY  # no task gets a whole day

    write = change_writer(str(tmp_path / "live"))
    starts = [utc(f"2026-01-01T10:{minute:02d}:00") for minute in range(0, 60, 5)]
    changed = spark.createDataFrame(
        [((start, start), kind, 1) for start in starts for kind in ("low", "high")],
        "window STRUCT<start: TIMESTAMP, end: TIMESTAMP>, priority STRING, ticket_count BIGINT",
    )
    write(changed.repartition(4), 0)
    assert len(list((tmp_path / "live").glob("day=*/batch_id=0/part-*.parquet"))) <= FILES_PER_DAY


def test_compaction_of_closed_days(spark, tmp_path):
    """Counts stay the same between and after the runs; folders of old days stay few."""
    out = str(tmp_path / "log")
    write = change_writer(out)

    def changed(day, count):
        windows = [utc(f"2026-01-{day:02d}T{hour:02d}:00:00") for hour in range(24)]
        return spark.createDataFrame(
            [((start, start), kind, count) for start in windows for kind in ("low", "high")],
            "window STRUCT<start: TIMESTAMP, end: TIMESTAMP>, priority STRING, ticket_count BIGINT",
        )

    def log_folders():
        return sorted(str(path.relative_to(out)) for path in (tmp_path / "log").glob("day=*/batch_id=*"))

    def counts():
        return set(rows(latest_counts(spark, out, "priority")))

    for batch in range(12):
        write(changed(1 + batch // 6, batch), batch)
    expected = counts()
    open_reader = latest_counts(spark, out, "priority")
    limit = date(2026, 1, 2)
    compact_changes(spark, out, "priority", before=limit)
    assert counts() == expected and len(log_folders()) == 12
    assert set(rows(open_reader)) == expected
    compact_changes(spark, out, "priority", before=limit)
    assert counts() == expected
    assert log_folders() == [f"day=2026-01-02/batch_id={batch}" for batch in sorted(range(6, 12), key=str)]

    write(changed(1, 50), 12)  # a late change of a compacted day
    late = counts()
    assert late != expected
    for _ in range(3):
        compact_changes(spark, out, "priority", before=limit)
        assert counts() == late
    assert not [name for name in log_folders() if "01-01" in name]
    assert len(list((tmp_path / "log" / "_compacted" / "day=2026-01-01").glob("upto=*"))) == 1
    days = {"first_day": date(2026, 1, 1), "last_day": date(2026, 1, 1)}
    assert latest_counts(spark, out, "priority", **days).count() == 48


def test_compaction_that_died_is_run_again(spark, tmp_path):
    out = str(tmp_path / "log")
    start = utc("2026-01-01T10:00:00")
    schema = "window STRUCT<start: TIMESTAMP, end: TIMESTAMP>, priority STRING, ticket_count BIGINT"
    for batch in range(3):
        change_writer(out)(spark.createDataFrame([((start, start), "low", batch)], schema), batch)
    limit = date(2026, 1, 2)
    compact_changes(spark, out, "priority", before=limit)
    os.remove(tmp_path / "log" / "_compacted" / "day=2026-01-01" / "upto=2" / "_SUCCESS")
    compact_changes(spark, out, "priority", before=limit)  # nothing is removed on an unfinished folder
    assert len(list((tmp_path / "log").glob("day=*/batch_id=*"))) == 3
    compact_changes(spark, out, "priority", before=limit)
    assert not list((tmp_path / "log").glob("day=*/batch_id=*"))
    assert rows(latest_counts(spark, out, "priority").select("ticket_count")) == [(2,)]


@pytest.mark.parametrize("mode", ["last_batch", "cumulative"])
def test_exports_after_a_lost_commit(spark, topic, tmp_path, mode):
    """The process dies between publishing a batch and the stream's commit of it."""
    root, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    exporter = BatchExporter(root, mode=mode)
    crashes = [2, 4]

    def export_then_crash(batch, batch_id):
        exporter(batch, batch_id)
        if crashes and batch_id == crashes[0]:
            crashes.pop(0)
            raise OSError("process lost")

    export_then_crash.root = root

    def run():
        stream = in_time_order(spark, topic)
        wait_for(start_exports(stream, export_then_crash, checkpoint, ONCE))

    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="process lost"):
            run()
    run()
    assert not crashes

    tickets = enriched_tickets(read_records(spark, topic))
    if mode == "last_batch":
        tickets = tickets.filter(F.expr("conv(substr(ticket_id, 4), 16, 10) * 6 >= 5000"))
    assert rows(read_export(spark, root, "agg_by_type")) == rows(ops.count_by_type(tickets))
    assert rows(read_export(spark, root, "agg_top_clients")) == rows(ops.top_clients(tickets))


def test_change_log_after_a_lost_commit(spark, topic, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    crashes = [1, 3]

    def write_then_crash(changed, batch_id):
        change_writer(out)(changed, batch_id)
        if crashes and batch_id == crashes[0]:
            crashes.pop(0)
            raise OSError("process lost")

    def run():
        counts = ops.window_counts(in_time_order(spark, topic), *TYPE_KEYS)
        writer = counts.writeStream.outputMode("update").foreachBatch(write_then_crash)
        writer = writer.option("checkpointLocation", checkpoint).trigger(**ONCE)
        wait_for(writer.start())

    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="process lost"):
            run()
    run()
    expected = ops.window_counts(enriched_tickets(read_records(spark, topic)), *TYPE_KEYS)
    latest = latest_counts(spark, out, *TYPE_KEYS)
    assert text_counts(latest, TYPE_KEYS) == text_counts(expected, TYPE_KEYS)
