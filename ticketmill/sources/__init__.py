from ticketmill.sources.events import (
    event_records,
    event_tickets,
    read_events,
    stream_events,
    ticket_records,
)
from ticketmill.sources.kafka import publish_to_kafka, start_kafka_publish, stream_kafka
from ticketmill.sources.records import (
    read_accepted,
    read_enriched,
    read_records,
    read_rejected,
    stream_accepted,
    stream_enriched,
    stream_records,
)

__all__ = [
    "event_records",
    "event_tickets",
    "publish_to_kafka",
    "read_accepted",
    "read_enriched",
    "read_events",
    "read_records",
    "read_rejected",
    "start_kafka_publish",
    "stream_accepted",
    "stream_enriched",
    "stream_events",
    "stream_kafka",
    "stream_records",
    "ticket_records",
]
