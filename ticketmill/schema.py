"""Schemas and fixed business values."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Names, spellings and durations below are part of the data contract.

TOPIC = "client_tickets"

TICKET_FIELDS = ("ticket_id", "client_id", "created_at", "request", "request_type", "priority")

TEAM_BY_REQUEST_TYPE = {
    "incident_technique": "Equipe Infrastructure",
    "demande_information": "Support Client N1",
    "demande_evolution": "Equipe Produit",
    "maintenance": "Equipe Operations",
    "facturation": "Service Comptabilite",
}
DEFAULT_TEAM = "Support General"

WINDOW_LENGTH = "5 minutes"
WATERMARK_DELAY = "1 minute"
INGEST_TRIGGER = "30 seconds"
EXPORT_TRIGGER = "60 seconds"
TOP_CLIENTS = 10

# Names of the targets, which are the names of the streaming queries as well.
ENRICHED_TARGET = "enriched_tickets"
CHECKED_TARGET = "checked_records"
BY_TYPE_TARGET = "tickets_by_type"
BY_PRIORITY_TARGET = "tickets_by_priority"
EXPORTS_QUERY = "batch_aggregations"

# Defaults of the job's environment variables.
DEFAULT_SERVERS = "localhost:9092"
DEFAULT_OUTPUT = "output"
# ----------------------------------------------------------------------------

# JSON fields are declared nullable because from_json never enforces otherwise;
# operators.validate is what turns "required" into a rule.
TICKET_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in TICKET_FIELDS])

# Columns of a Kafka record, so that files can stand in for a topic.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

ENRICHED_SCHEMA = T.StructType(
    [
        T.StructField("ticket_id", T.StringType()),
        T.StructField("client_id", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("request", T.StringType()),
        T.StructField("request_type", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("assigned_team", T.StringType()),
        T.StructField("processing_timestamp", T.TimestampType()),
    ]
)

# Strict mode keeps accepted tickets and refused records in one table, apart by folder.
ACCEPTED, REJECTED = "accepted", "rejected"
REJECT_COLUMNS = ("topic", "partition", "offset", "kafka_timestamp", "key", "reject_reason", "value")
CHECKED_SCHEMA = T.StructType(
    [
        *ENRICHED_SCHEMA,
        *[RECORD_SCHEMA[name] for name in ("topic", "partition", "offset", "key", "value")],
        T.StructField("reject_reason", T.StringType()),
        T.StructField("verdict", T.StringType()),
        T.StructField("ingest_day", T.DateType()),
    ]
)

# Input table the tickets of the registered queries are derived from.
EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
