"""The six exports: golden result, order, retries, crashes and running totals."""

import json
import os
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

import ticketmill.sinks.exports as exports
from ticketmill import operators as ops
from ticketmill.sinks import EXPORTS, BatchExporter, LostCheckpointError, read_export, read_totals
from ticketmill.sinks.runs import Run, due

# One recorded micro-batch of 60 tickets, as counts per type and per priority.
GOLDEN_TYPES = [
    ("facturation", "Service Comptabilite", 18),
    ("demande_evolution", "Equipe Produit", 14),
    ("incident_technique", "Equipe Infrastructure", 11),
    ("demande_information", "Support Client N1", 10),
    ("maintenance", "Equipe Operations", 7),
]
GOLDEN_PRIORITIES = [("medium", 26), ("low", 17), ("high", 10), ("critical", 7)]


def batch_of(spark, kinds, priorities, clients=None, first_second=0):
    count = len(kinds)
    clients = clients or [f"CLI-{i % 13:04d}" for i in range(count)]
    data = [
        (clients[i], kinds[i], priorities[i], first_second + i * 300) for i in range(count)
    ]
    frame = spark.createDataFrame(
        data, "client_id STRING, request_type STRING, priority STRING, s BIGINT"
    )
    return ops.enrich_tickets(frame.withColumn("created_at", F.timestamp_seconds("s")).drop("s"))


@pytest.fixture
def golden(spark):
    kinds = [kind for kind, _, n in GOLDEN_TYPES for _ in range(n)]
    priorities = [priority for priority, n in GOLDEN_PRIORITIES for _ in range(n)]
    return batch_of(spark, kinds, priorities)


def data_files(folder):
    return sorted(name for name in os.listdir(folder) if name.startswith("part-"))


def test_golden_files(spark, golden, tmp_path):
    BatchExporter(str(tmp_path), in_place=True)(golden, 0)
    (by_type,) = data_files(tmp_path / "json_by_type")
    assert (tmp_path / "json_by_type" / by_type).read_text().splitlines() == [
        json.dumps(
            {"request_type": kind, "assigned_team": team, "ticket_count": n},
            separators=(",", ":"),
        )
        for kind, team, n in GOLDEN_TYPES
    ]
    (by_priority,) = data_files(tmp_path / "json_by_priority")
    assert (tmp_path / "json_by_priority" / by_priority).read_text().splitlines() == [
        json.dumps({"priority": priority, "ticket_count": n}, separators=(",", ":"))
        for priority, n in GOLDEN_PRIORITIES
    ]
    assert rows(spark.read.parquet(str(tmp_path / "agg_by_type"))) == GOLDEN_TYPES
    assert rows(spark.read.parquet(str(tmp_path / "agg_by_priority"))) == GOLDEN_PRIORITIES
    assert rows(spark.read.parquet(str(tmp_path / "agg_hourly_volume"))) == [
        (hour, 12) for hour in range(5)
    ]
    assert rows(spark.read.parquet(str(tmp_path / "agg_top_clients"))) == [
        (f"CLI-{i:04d}", 5 if i < 8 else 4) for i in range(10)
    ]
    for name in EXPORTS:
        assert len(data_files(tmp_path / name)) == 1


def snapshot(spark, root):
    return {name: rows(read_export(spark, root, name)) for name in EXPORTS}


def test_same_batch_twice(spark, golden, tmp_path):
    for mode in ("last_batch", "cumulative"):
        root = str(tmp_path / mode)
        exporter = BatchExporter(root, mode=mode)
        exporter(golden, 0)
        first = snapshot(spark, root)
        exporter(golden, 0)
        assert snapshot(spark, root) == first


def expected_exports(batches):
    """The exports over some batches, counted in Python."""
    data = [row for batch in batches for row in batch.collect()]
    by_type = Counter((r.request_type, r.assigned_team) for r in data)
    by_priority = Counter(r.priority for r in data)
    by_hour = Counter(r.created_at.hour for r in data)
    by_client = Counter(r.client_id for r in data)
    ranked_types = sorted(((*k, n) for k, n in by_type.items()), key=lambda r: (-r[2], r))
    ranked_priorities = sorted(by_priority.items(), key=lambda r: (-r[1], r))
    return {
        "agg_by_type": ranked_types,
        "agg_by_priority": ranked_priorities,
        "agg_hourly_volume": sorted(by_hour.items()),
        "agg_top_clients": sorted(by_client.items(), key=lambda r: (-r[1], r))[:10],
        "json_by_type": ranked_types,
        "json_by_priority": ranked_priorities,
    }


@pytest.fixture
def batches(spark):
    kinds = ["maintenance", "facturation", "autre", "maintenance"]
    priorities = ["low", "high", "low", "medium"]
    return [
        batch_of(spark, kinds, priorities, ["CLI-1", "CLI-1", "CLI-2", f"CLI-{n}"], n * 3600)
        for n in range(7)
    ]


@pytest.mark.parametrize("mode", ["last_batch", "cumulative"])
@pytest.mark.parametrize("retention", [0, 3600])
def test_modes_over_many_batches(spark, batches, tmp_path, mode, retention):
    exporter = BatchExporter(str(tmp_path), mode=mode, retention_seconds=retention)
    for number, batch in enumerate(batches):
        exporter(batch, number * 2)  # batch ids may have gaps
        covered = batches[: number + 1] if mode == "cumulative" else [batch]
        assert snapshot(spark, str(tmp_path)) == expected_exports(covered)
    kept = 7 if retention else 1
    assert len(os.listdir(tmp_path / "agg_by_type")) == kept
    assert len(list((tmp_path / "_published").glob("sequence=*"))) == kept
    clients = Counter(r.client_id for batch in covered for r in batch.collect())
    assert dict(rows(read_totals(spark, str(tmp_path), "by_client"))) == dict(clients)


@pytest.mark.parametrize("mode", ["last_batch", "cumulative"])
def test_readers_keep_what_they_opened(spark, batches, tmp_path, mode):
    exporter = BatchExporter(str(tmp_path), mode=mode)
    exporter(batches[0], 0)
    opened = {name: read_export(spark, str(tmp_path), name) for name in EXPORTS}
    totals = read_totals(spark, str(tmp_path), "by_client")
    for number in range(1, 11):
        exporter(batches[number % 7], number)
    assert {name: rows(frame) for name, frame in opened.items()} == expected_exports(batches[:1])
    assert dict(rows(totals)) == dict(Counter(r.client_id for r in batches[0].collect()))


def bytes_of(folder):
    return sum(path.stat().st_size for path in folder.rglob("*.parquet"))


def test_a_batch_writes_little_of_the_totals(spark, tmp_path):
    """Batches of 1 % of a million clients write under 5 % of the table, and totals stay right."""
    exporter = BatchExporter(str(tmp_path), mode="cumulative")
    client = F.concat(F.lit("CLI-"), F.col("id").cast("string"))
    many = spark.range(0, 1_000_000, 1, 8).select(
        client.alias("client_id"), F.lit("autre").alias("request_type"), F.lit("low").alias("priority"),
        F.lit(None).cast("timestamp").alias("created_at"), F.lit("Support General").alias("assigned_team"),
    )
    exporter(many, 0)
    store = tmp_path / "_rollup"
    table, before = bytes_of(store), bytes_of(store)
    for number in range(1, 8):
        exporter(many.filter(F.crc32(F.encode("client_id", "utf-8")) % 100 == number % 3), number)
        after = bytes_of(store)
        assert 0 < after - before < 0.05 * table
        before = after
    found = read_totals(spark, str(tmp_path), "by_client")
    share = F.crc32(F.encode("client_id", "utf-8")) % 100
    wanted = F.when(share == 0, 3).when(share == 1, 4).when(share == 2, 3).otherwise(1)
    assert found.count() == 1_000_000
    assert found.filter(F.col("ticket_count") != wanted).count() == 0
    top = read_export(spark, str(tmp_path), "agg_top_clients")
    assert rows(top) == rows(found.orderBy(F.desc("ticket_count"), "client_id").limit(10))


def test_runs_stay_few(spark, tmp_path):
    """Merging keeps up: no part has more runs than there are parts and a few, and old runs are removed."""
    clients = [f"CLI-{i}" for i in range(40)]
    exporter = BatchExporter(str(tmp_path), mode="cumulative", retention_seconds=0)
    batch = batch_of(spark, ["autre"] * 40, ["low"] * 40, clients)
    for number in range(12):
        exporter(batch, number)
        (last,) = exports._all_published(spark, str(tmp_path))[-1:]
        assert sum(map(len, last.runs.values())) <= (number + 1) * len(last.runs) - number
    assert dict(rows(read_totals(spark, str(tmp_path), "by_client"))) == dict.fromkeys(clients, 12)
    named = {f"run={run.number}" for of_part in last.runs.values() for run in of_part}
    assert named <= set(os.listdir(tmp_path / "_rollup"))
    assert len(os.listdir(tmp_path / "_rollup")) <= len(named) + 2


@pytest.mark.parametrize(
    "sizes, merged", [([5], 1), ([100, 5], 1), ([10, 5], 2), ([100, 10, 5], 2), ([20, 9, 5], 3), ([1, 1, 1, 1], 4)]
)
def test_due_runs(sizes, merged):
    assert due([Run(at, size) for at, size in enumerate(sizes)]) == [
        Run(at, size) for at, size in enumerate(sizes)
    ][-merged:]


@pytest.mark.parametrize("mode", ["last_batch", "cumulative"])
def test_crash_between_targets(spark, batches, tmp_path, mode, monkeypatch):
    """Readers keep the previous batch until every target of the next is written."""
    root = str(tmp_path)
    exporter = BatchExporter(root, mode=mode)
    exporter(batches[0], 0)
    before = snapshot(spark, root)

    def fail(self, rollup, export, *more):
        if export.format == "json":
            raise OSError("lost")
        return original(self, rollup, export, *more)

    original = BatchExporter._result
    monkeypatch.setattr(BatchExporter, "_result", fail)
    with pytest.raises(OSError, match="lost"):
        exporter(batches[1], 1)
    monkeypatch.undo()
    assert snapshot(spark, root) == before

    exporter(batches[1], 1)
    covered = batches[:2] if mode == "cumulative" else [batches[1]]
    assert snapshot(spark, root) == expected_exports(covered)


def test_empty_batch_publishes_nothing(spark, batches, tmp_path):
    exporter = BatchExporter(str(tmp_path))
    exporter(batches[0].limit(0), 0)
    assert snapshot(spark, str(tmp_path)) == {name: [] for name in EXPORTS}
    assert rows(read_totals(spark, str(tmp_path), "by_client")) == []
    exporter(batches[0], 1)
    exporter(batches[0].limit(0), 2)
    assert snapshot(spark, str(tmp_path)) == expected_exports(batches[:1])


def test_dynamic_overwrite_setting_leaves_no_old_rows(spark, batches, tmp_path):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        exporter = BatchExporter(str(tmp_path), retention_seconds=0)
        for number in (0, 1, 2):
            exporter(batches[number], number)
        exporter(batches[0].limit(0), 3)
        assert snapshot(spark, str(tmp_path)) == expected_exports([batches[2]])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


@pytest.mark.parametrize("mode", ["last_batch", "cumulative"])
def test_reset_checkpoint_is_refused(batches, tmp_path, mode):
    exporter = BatchExporter(str(tmp_path), mode=mode)
    exporter(batches[0], 5)
    with pytest.raises(LostCheckpointError, match="checkpoint was reset"):
        exporter(batches[1], 0)


def test_large_result_is_sorted_across_its_files(spark, tmp_path):
    kinds = [f"kind-{i}" for i in range(500) for _ in range(1 + i % 3)]
    batch = batch_of(spark, kinds, ["low"] * len(kinds))
    BatchExporter(str(tmp_path), in_place=True)(batch, 0)
    folder = tmp_path / "json_by_type"
    lines = [
        json.loads(line)
        for name in data_files(folder)
        for line in (folder / name).read_text().splitlines()
    ]
    assert len(lines) == 500
    order = [(-line["ticket_count"], line["request_type"]) for line in lines]
    assert order == sorted(order)


def test_settings_are_checked(tmp_path):
    for wrong in ({"mode": "other"}, {"retention_seconds": -1}, {"mode": "cumulative", "in_place": True}):
        with pytest.raises(ValueError):
            BatchExporter(str(tmp_path), **wrong)


def test_input_is_read_once(spark, batches, tmp_path):
    """All six exports come from one pass over the batch."""
    passes = spark.sparkContext.accumulator(0)

    def watch(parts):
        passes.add(1)
        yield from parts

    schema = batches[0].schema
    BatchExporter(str(tmp_path))(batches[0].coalesce(1).mapInArrow(watch, schema), 0)
    assert passes.value == 1
    assert exports.EXPORTS.keys() == EXPORTS.keys()
