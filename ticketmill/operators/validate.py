"""Strict mode: split records into accepted tickets and rejects with a reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import rejection_reason, typed_rejection_reason
from ticketmill.operators.parse import decode_records, decode_variants, ticket_columns
from ticketmill.schema import ACCEPTED, REJECT_COLUMNS, REJECTED


def check_records(records: DataFrame, *keep: str, typed: bool = False) -> DataFrame:
    """Decoded records with ``reject_reason``, null where the ticket is valid.

    With ``typed`` the payload is read once as a variant, which tells what each field is:
    numbers, nested values and unknown fields are refused, where reading text takes them.
    """
    if typed:
        decoded = decode_variants(records, *keep)
        reason = typed_rejection_reason(F.col("payload"), F.col("fields"))
        return decoded.withColumn("reject_reason", reason).drop("fields")
    return decode_records(records, *keep, parse_once=True).withColumn(
        "reject_reason", rejection_reason(F.col("payload"), F.col("ticket"))
    )


def accepted_tickets(records: DataFrame, typed: bool = False) -> DataFrame:
    """Valid tickets, with the columns of ``parse_tickets``."""
    return check_records(records, typed=typed).filter(F.col("reject_reason").isNull()).select(*ticket_columns())


def checked_tickets(records: DataFrame, typed: bool = False) -> DataFrame:
    """Accepted and refused records together, from one pass: tickets, reasons and a ``verdict``.

    Refused records keep their payload and key; accepted ones have it in their columns.
    """
    refused = F.col("reject_reason").isNotNull()
    places = ("topic", "partition", "offset", "key", "value")
    return check_records(records, *places, typed=typed).select(
        *ticket_columns(),
        *[F.when(refused, F.col(name)).alias(name) for name in places],
        "reject_reason",
        F.when(refused, REJECTED).otherwise(ACCEPTED).alias("verdict"),
    )


def rejected_records(records: DataFrame, typed: bool = False) -> DataFrame:
    """Refused records with their place in the topic, reason and untouched payload."""
    checked = checked_tickets(records, typed)
    return checked.filter(F.col("verdict") == REJECTED).select(*REJECT_COLUMNS)
