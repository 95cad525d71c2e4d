"""The streaming queries. Every one is named, checkpointed and safe to restart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ticketmill.operators import window_counts
from ticketmill.schema import (
    CHECKED_TARGET,
    ENRICHED_TARGET,
    EXPORT_TRIGGER,
    EXPORTS_QUERY,
    INGEST_TRIGGER,
)
from ticketmill.session import state_partitions
from ticketmill.sinks import BatchExporter, change_writer
from ticketmill.sinks.owner import checkpoint_id, record_owner, refuse_other_owner

Trigger = Mapping[str, object]
EVERY_INGEST: Trigger = {"processingTime": INGEST_TRIGGER}
EVERY_EXPORT: Trigger = {"processingTime": EXPORT_TRIGGER}
ONCE: Trigger = {"availableNow": True}

# Keys of the two windowed counts.
TYPE_KEYS = ("request_type", "assigned_team")
PRIORITY_KEYS = ("priority",)


def _writer(
    stream: DataFrame, name: str, checkpoint: str, trigger: Trigger, target: str
) -> DataStreamWriter:
    """A named, checkpointed writer; refused if the target was filled from another checkpoint."""
    spark = stream.sparkSession
    refuse_other_owner(spark, target, checkpoint_id(spark, checkpoint))
    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )


def _start_files(
    writer: DataStreamWriter, stream: DataFrame, path: str, retention: str | None = None
) -> StreamingQuery:
    """Start an appending Parquet sink and note which query its target belongs to.

    ``retention`` bounds the sink's commit log: files older than it leave the log, and
    with it the table, for every reader.
    """
    if retention:
        writer = writer.option("retention", retention)
    query = writer.outputMode("append").format("parquet").start(path)
    record_owner(stream.sparkSession, path, query.id)
    return query


def start_enriched_table(
    enriched: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger = EVERY_INGEST,
    name: str = ENRICHED_TARGET,
    retention: str | None = None,
) -> StreamingQuery:
    """Append enriched tickets to Parquet by day of ingest; the commit log makes it exactly-once.

    No shuffle: each input task writes its own files.
    """
    by_day = enriched.withColumn("ingest_day", F.to_date("processing_timestamp"))
    writer = _writer(by_day, name, checkpoint, trigger, path).partitionBy("ingest_day")
    return _start_files(writer, by_day, path, retention)


def start_checked_table(
    checked: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger = EVERY_INGEST,
    name: str = CHECKED_TARGET,
    retention: str | None = None,
) -> StreamingQuery:
    """Append accepted tickets and refused records, apart by folder, from one pass over the records."""
    by_day = checked.withColumn("ingest_day", F.to_date("processing_timestamp"))
    writer = _writer(by_day, name, checkpoint, trigger, path).partitionBy("verdict", "ingest_day")
    return _start_files(writer, by_day, path, retention)


def start_window_changes(
    tickets: DataFrame,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    name: str,
    trigger: Trigger = EVERY_INGEST,
    partitions: int | None = None,
) -> StreamingQuery:
    """Windowed counts in update mode: each micro-batch logs the counts it changed."""
    with state_partitions(tickets.sparkSession, partitions):
        return (
            _writer(window_counts(tickets, *keys), name, checkpoint, trigger, path)
            .outputMode("update")
            .foreachBatch(change_writer(path))
            .start()
        )


def start_window_table(
    tickets: DataFrame,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    name: str,
    trigger: Trigger = EVERY_INGEST,
    partitions: int | None = None,
) -> StreamingQuery:
    """Windowed counts in append mode: each closed window is written once, finally."""
    counts = window_counts(tickets, *keys)
    with state_partitions(tickets.sparkSession, partitions):
        return _start_files(_writer(counts, name, checkpoint, trigger, path), counts, path)


def start_exports(
    enriched: DataFrame,
    exporter: BatchExporter,
    checkpoint: str,
    trigger: Trigger = EVERY_EXPORT,
    name: str = EXPORTS_QUERY,
) -> StreamingQuery:
    """Hand each micro-batch to the exporter."""
    return start_batches(enriched, exporter, checkpoint, name, trigger)


class BatchSink(Protocol):
    """What fills the folder ``root`` from each micro-batch, the same for the same batch id."""

    root: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None: ...


def start_batches(
    tickets: DataFrame, sink: BatchSink, checkpoint: str, name: str, trigger: Trigger = EVERY_INGEST
) -> StreamingQuery:
    """Hand each micro-batch to a sink such as ``ClientSequencer`` or ``LateTickets``."""
    return _writer(tickets, name, checkpoint, trigger, sink.root).foreachBatch(sink).start()


def wait_for(*queries: StreamingQuery) -> None:
    """Wait until bounded (``ONCE``) queries end; the first failure stops the others."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
