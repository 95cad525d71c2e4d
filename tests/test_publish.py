import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ticketmill.operators import keyed_records, partition_by_client
from ticketmill.schema import TICKET_FIELDS


def test_keyed_json(spark):
    frame = spark.createDataFrame(
        [
            ("TK-1", "CLI-0001", "2026-01-01T00:00:00Z", 'é "x"\n', "maintenance", "low"),
            ("TK-2", None, None, "b", "autre", "high"),
        ],
        ", ".join(f"{name} STRING" for name in TICKET_FIELDS),
    )
    first, second = keyed_records(frame).collect()
    assert bytes(first.key) == b"CLI-0001"
    assert json.loads(first.value.decode("utf-8")) == {
        "ticket_id": "TK-1",
        "client_id": "CLI-0001",
        "created_at": "2026-01-01T00:00:00Z",
        "request": 'é "x"\n',
        "request_type": "maintenance",
        "priority": "low",
    }
    assert second.key is None
    assert json.loads(second.value) == {
        "ticket_id": "TK-2",
        "request": "b",
        "request_type": "autre",
        "priority": "high",
    }


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the tickets belong to one client, some to the null client."""
    return (
        spark.range(3000)
        .select(
            F.when(F.col("id") % 2 == 0, "CLI-HOT")
            .when(F.col("id") % 9 == 0, None)
            .otherwise(F.concat(F.lit("CLI-"), F.col("id") % 40))
            .alias("client_id"),
            F.timestamp_seconds((F.col("id") * 7919) % 500).alias("created_at"),
            F.concat(F.lit("TK-"), "id").alias("ticket_id"),
        )
        .repartition(7)
    )


def layout(frame, path):
    """Tickets in file order: (file, client, time, ticket)."""
    frame.write.parquet(path)
    read = frame.sparkSession.read.parquet(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        "client_id",
        "created_at",
        "ticket_id",
    )
    columns = ("file", "client_id", "created_at", "ticket_id")
    return rows(read.orderBy("file", "row").select(*columns))


def check_order(found, source):
    assert sorted(r[3] for r in found) == sorted(r.ticket_id for r in source.collect())
    by_client = {}
    for _, client, time, ticket in found:
        by_client.setdefault(client, []).append((time, ticket))
    for tickets in by_client.values():
        assert tickets == sorted(tickets)


def files_of(found):
    files = {}
    for file, client, _, _ in found:
        files.setdefault(client, set()).add(file)
    return files


@pytest.mark.parametrize("partitions", [1, 6, 40])
def test_clients_lie_in_consecutive_partitions_in_order(skewed, tmp_path, partitions):
    """One rule at every size; half of all tickets belong to one client."""
    found = layout(partition_by_client(skewed, partitions), str(tmp_path / "out"))
    check_order(found, skewed)
    names = sorted({r[0] for r in found})
    for files in files_of(found).values():
        places = sorted(names.index(name) for name in files)
        assert places == list(range(places[0], places[-1] + 1))
    if partitions > 1:
        assert len(files_of(found)["CLI-HOT"]) >= partitions // 3


def test_columns_are_unchanged(skewed):
    assert partition_by_client(skewed, 4).columns == skewed.columns
    assert rows(partition_by_client(skewed.limit(0))) == []


def test_copies_of_one_ticket_are_spread(spark):
    copies = spark.range(2000).select(
        F.lit("CLI-1").alias("client_id"),
        F.timestamp_seconds(F.lit(0)).alias("created_at"),
        F.lit("TK-1").alias("ticket_id"),
        F.col("id").alias("offset"),
    )
    placed = partition_by_client(copies, 4, tell_apart=["offset"])
    sizes = placed.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and sum(row["count"] for row in sizes) == 2000
    assert max(row["count"] for row in sizes) < 1000
