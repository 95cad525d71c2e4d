"""Topic records to typed ticket columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import event_time
from ticketmill.schema import TICKET_FIELDS, TICKET_SCHEMA


def decode_records(records: DataFrame, *keep: str, parse_once: bool = False) -> DataFrame:
    """The payload read as JSON into a ``ticket`` struct, beside the broker time.

    Unreadable payloads give null fields; no row is lost. ``keep`` names further
    record columns to carry along.

    Spark prunes the JSON schema to the fields a query uses, and copies the parse
    into every filter on them. With ``parse_once`` the struct passes through a
    one-element explode, which no filter is pushed below, so each payload is parsed
    once. That is the cheaper way if a filter (or a time window, which filters null
    times) reads a parsed field, and only then: without such a filter the explode
    costs and gains nothing.
    """
    texts = records.selectExpr(
        "CAST(value AS STRING) AS payload", "timestamp AS kafka_timestamp", *keep
    )
    ticket = F.from_json("payload", TICKET_SCHEMA)
    return texts.select("*", (F.explode(F.array(ticket)) if parse_once else ticket).alias("ticket"))


def decode_variants(records: DataFrame, *keep: str) -> DataFrame:
    """Records as ``decode_records`` gives them, with ``fields``: all top-level fields as variants.

    ``fields`` is null where the payload isn't one JSON object; a field given twice makes it
    unreadable. Fields of ``ticket`` are null where theirs isn't text. Each payload is parsed once.
    """
    texts = records.selectExpr("CAST(value AS STRING) AS payload", "timestamp AS kafka_timestamp", *keep)
    fields = F.try_variant_get(F.try_parse_json("payload"), "$", "map<string,variant>")
    parsed = texts.select("*", F.explode(F.array(fields)).alias("fields"))
    own = {name: F.try_element_at("fields", F.lit(name)) for name in TICKET_FIELDS}
    text = {name: F.when(F.schema_of_variant(own[name]) == "STRING", F.try_variant_get(own[name], "$", "string")) for name in own}
    return parsed.select("*", F.struct(*[text[name].alias(name) for name in own]).alias("ticket"))


def ticket_columns() -> list[Column]:
    """Flat, typed columns of a decoded record, in table order."""
    fields = {name: F.col(f"ticket.{name}") for name in TICKET_FIELDS}
    fields["created_at"] = event_time(fields["created_at"]).alias("created_at")
    return [*fields.values(), F.col("kafka_timestamp")]


def parse_tickets(records: DataFrame, parse_once: bool = False) -> DataFrame:
    """One row per record, also for malformed ones (their ticket columns are null)."""
    return decode_records(records, parse_once=parse_once).select(*ticket_columns())
