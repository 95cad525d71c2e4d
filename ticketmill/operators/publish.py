"""Keyed JSON records, and tickets laid out client by client."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import ticket_json


def keyed_records(tickets: DataFrame) -> DataFrame:
    """``key`` (client id) and ``value`` (UTF-8 JSON object) of each ticket, both binary.

    ``created_at`` is expected as the ISO text that goes on the wire. Null fields
    are left out of the object, which reads back the same.
    """
    return tickets.select(
        F.col("client_id").cast("binary").alias("key"),
        ticket_json().cast("binary").alias("value"),
    )


def partition_by_client(
    tickets: DataFrame, partitions: int | None = None, tell_apart: Sequence[str] = ()
) -> DataFrame:
    """Lay tickets out by client and, within a client, in order of creation time.

    The tickets are dealt out by ranges of (client, time, ticket), sampled once, and sorted
    in each partition. So a client's tickets lie in consecutive partitions, one after
    another in order; a client with many tickets has several, whatever the size of the
    table. The planner chooses the number of partitions unless it is given.

    ``tell_apart`` names columns that differ between copies of one ticket, such as
    the record offset. With them even a single ticket that was sent very many times
    is spread over several partitions.

    Range partitioning samples its input, so this works on tables, not on streams.
    """
    order = ("client_id", "created_at", "ticket_id", *tell_apart)
    sizes = [] if partitions is None else [partitions]
    return tickets.repartitionByRange(*sizes, *order).sortWithinPartitions(*order)
