"""Kafka adapter. Needs the spark-sql-kafka-0-10 package on the class path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ticketmill.schema import TOPIC


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Records of a topic as a stream with ``RECORD_SCHEMA``.

    ``max_offsets_per_trigger`` bounds one micro-batch, which matters when a new
    query starts from the beginning of a long topic. ``min_partitions`` lets one
    large topic partition be read by several tasks.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load()


def publish_to_kafka(records: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Send a bounded DataFrame of keyed records; Kafka places them by key."""
    (
        records.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def start_kafka_publish(
    records: DataFrame,
    servers: str,
    checkpoint: str,
    topic: str = TOPIC,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Send a stream of keyed records as they come. A restart may repeat some of them."""
    return (
        records.select("key", "value")
        .writeStream.queryName(f"publish_{topic}")
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )
