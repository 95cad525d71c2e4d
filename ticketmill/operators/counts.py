"""Ticket counts: whole-table, top-k and per event-time window.

Every count is a partial aggregate per task, one exchange of the partial results,
and a final aggregate. A key that holds a third of all rows therefore shuffles
one row per task, not its tickets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.schema import TOP_CLIENTS, WATERMARK_DELAY, WINDOW_LENGTH

COUNT = "ticket_count"


def _count() -> Column:
    return F.count("*").alias(COUNT)


def with_hour(tickets: DataFrame) -> DataFrame:
    """Add the hour of day (0-23) of the event time; null for a null time."""
    return tickets.withColumn("hour", F.hour("created_at"))


def count_by(tickets: DataFrame, *keys: str) -> DataFrame:
    """Tickets per key. Null is a key like any other."""
    return tickets.groupBy(*keys).agg(_count())


def count_by_type(tickets: DataFrame) -> DataFrame:
    return count_by(tickets, "request_type", "assigned_team").orderBy(
        F.desc(COUNT), "request_type", "assigned_team"
    )


def count_by_priority(tickets: DataFrame) -> DataFrame:
    return count_by(tickets, "priority").orderBy(F.desc(COUNT), "priority")


def count_by_hour(tickets: DataFrame) -> DataFrame:
    """Tickets per hour of day across all days, null hour first."""
    return count_by(with_hour(tickets), "hour").orderBy("hour")


def count_by_client(tickets: DataFrame) -> DataFrame:
    """Tickets per client, unordered: there may be many clients."""
    return count_by(tickets, "client_id")


def top_clients(tickets: DataFrame, n: int = TOP_CLIENTS) -> DataFrame:
    """The ``n`` clients with most tickets; equal counts are ordered by client id."""
    return count_by_client(tickets).orderBy(F.desc(COUNT), "client_id").limit(n)


def row_count(tickets: DataFrame) -> DataFrame:
    return tickets.agg(_count())


def window_counts(
    tickets: DataFrame,
    *keys: str,
    length: str = WINDOW_LENGTH,
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """Tickets per tumbling event-time window and key.

    Windows are aligned to the epoch and half-open. Tickets without an event time
    belong to no window. On a stream ``delay`` is the watermark; on a table it has
    no effect.
    """
    return (
        tickets.filter(F.col("created_at").isNotNull())
        .withWatermark("created_at", delay)
        .groupBy(F.window("created_at", length), *keys)
        .agg(_count())
    )


def window_counts_by_type(tickets: DataFrame, **options: str) -> DataFrame:
    return window_counts(tickets, "request_type", "assigned_team", **options)


def window_counts_by_priority(tickets: DataFrame, **options: str) -> DataFrame:
    return window_counts(tickets, "priority", **options)


# Key columns of each whole-table count, in the order of its result.
ROLLUP_KEYS = {
    "by_type": ("request_type", "assigned_team"),
    "by_priority": ("priority",),
    "by_hour": ("hour",),
    "by_client": ("client_id",),
}
ROLLUP_COLUMNS = tuple(key for keys in ROLLUP_KEYS.values() for key in keys)


def rollup_counts(tickets: DataFrame) -> DataFrame:
    """All four whole-table counts from one pass over the tickets.

    Result: ``target`` (a key of ``ROLLUP_KEYS``), the key columns (null where a
    target does not use them) and the count. Reading the input once matters in a
    micro-batch, where each further pass would fetch and parse the records again.
    """
    target = F.when(F.grouping("client_id") == 0, "by_client")
    for name in ("by_hour", "by_priority"):
        target = target.when(F.grouping(ROLLUP_KEYS[name][0]) == 0, name)
    return (
        with_hour(tickets)
        .select(*ROLLUP_COLUMNS)
        .groupingSets([list(keys) for keys in ROLLUP_KEYS.values()], *ROLLUP_COLUMNS)
        .agg(target.otherwise("by_type").alias("target"), _count())
        .select("target", *ROLLUP_COLUMNS, COUNT)
    )
