from ticketmill.sinks.changes import change_writer, compact_changes, latest_counts, read_changes
from ticketmill.sinks.exports import EXPORTS, BatchExporter, read_export, read_totals
from ticketmill.sinks.late import LateTickets
from ticketmill.sinks.owner import LostCheckpointError
from ticketmill.sinks.sequences import ClientSequencer

__all__ = [
    "EXPORTS",
    "BatchExporter",
    "ClientSequencer",
    "LateTickets",
    "LostCheckpointError",
    "change_writer",
    "compact_changes",
    "latest_counts",
    "read_changes",
    "read_export",
    "read_totals",
]
