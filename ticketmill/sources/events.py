"""Tickets and topic records derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.functions import ticket_json
from ticketmill.schema import EVENTS_SCHEMA, TOPIC

# Fixed values of the derivation.
REQUEST_TYPE_BY_EVENT = {
    "error": "incident_technique",
    "view": "demande_information",
    "signup": "demande_evolution",
    "click": "maintenance",
    "purchase": "facturation",
}
UNMAPPED_TYPE = "autre"
UNMAPPED_EVERY = 50
TOPIC_PARTITIONS = 3


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream, be it one file or a folder of files.

    A plain streaming path must be a folder, a pattern may also match a file.
    """
    return spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/event[s].parquet")


def _zero_padded(text: Column, width: int) -> Column:
    """Pad to at least ``width``; longer ids keep every digit, so no two ids merge."""
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), "0")


def event_tickets(events: DataFrame) -> DataFrame:
    """One ticket per event: the six wire fields as text, plus event_id, user_id and ts."""
    # A column of its own, so that the three comparisons below read props once.
    events = events.withColumn("digit", F.get_json_object("props", "$.k").cast("int") % 10)
    digit = F.col("digit")
    kind = F.create_map(*[F.lit(part) for pair in REQUEST_TYPE_BY_EVENT.items() for part in pair])
    return events.select(
        "event_id",
        "user_id",
        "ts",
        F.concat(F.lit("TK-"), _zero_padded(F.hex("event_id"), 8)).alias("ticket_id"),
        F.concat(F.lit("CLI-"), _zero_padded(F.col("user_id").cast("string"), 4)).alias(
            "client_id"
        ),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"),
        F.col("props").alias("request"),
        F.when(F.col("event_id") % UNMAPPED_EVERY == 0, UNMAPPED_TYPE)
        .otherwise(
            F.coalesce(
                F.try_element_at(kind, F.col("event_type")),
                F.lit(REQUEST_TYPE_BY_EVENT["purchase"]),
            )
        )
        .alias("request_type"),
        F.when(digit == 0, "critical")
        .when(digit <= 2, "high")
        .when(digit <= 5, "low")
        .otherwise("medium")
        .alias("priority"),
    )


def ticket_records(tickets: DataFrame, value: Column | None = None) -> DataFrame:
    """Topic records of :func:`event_tickets`: JSON payload keyed by client.

    ``value`` replaces the payload expression; it may use every ticket column.
    """
    payload = value if value is not None else ticket_json()
    return tickets.select(
        F.col("client_id").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.pmod("user_id", F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def event_records(events: DataFrame, value: Column | None = None) -> DataFrame:
    return ticket_records(event_tickets(events), value)
