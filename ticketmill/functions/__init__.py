from ticketmill.functions.columns import (
    event_time,
    full_iso_time,
    is_ticket_time,
    rejection_reason,
    team_for,
    ticket_json,
    typed_rejection_reason,
)

__all__ = [
    "event_time",
    "full_iso_time",
    "is_ticket_time",
    "rejection_reason",
    "team_for",
    "ticket_json",
    "typed_rejection_reason",
]
