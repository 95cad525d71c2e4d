from ticketmill.operators.counts import (
    count_by,
    count_by_client,
    count_by_hour,
    count_by_priority,
    count_by_type,
    rollup_counts,
    row_count,
    top_clients,
    window_counts,
    window_counts_by_priority,
    window_counts_by_type,
    with_hour,
)
from ticketmill.operators.enrich import enrich_tickets, enrich_tickets_from_table, team_table
from ticketmill.operators.heavy import candidate_tickets, top_clients_of_many
from ticketmill.operators.numbering import number_rows, number_within, rank_rows
from ticketmill.operators.parse import decode_records, parse_tickets
from ticketmill.operators.publish import keyed_records, partition_by_client
from ticketmill.operators.validate import (
    accepted_tickets,
    check_records,
    checked_tickets,
    rejected_records,
)

__all__ = [
    "accepted_tickets",
    "candidate_tickets",
    "check_records",
    "checked_tickets",
    "count_by",
    "count_by_client",
    "count_by_hour",
    "count_by_priority",
    "count_by_type",
    "decode_records",
    "enrich_tickets",
    "enrich_tickets_from_table",
    "keyed_records",
    "number_rows",
    "number_within",
    "parse_tickets",
    "partition_by_client",
    "rank_rows",
    "rejected_records",
    "rollup_counts",
    "row_count",
    "team_table",
    "top_clients",
    "top_clients_of_many",
    "window_counts",
    "window_counts_by_priority",
    "window_counts_by_type",
    "with_hour",
]
