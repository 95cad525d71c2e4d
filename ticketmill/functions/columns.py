"""Column expressions. All are built-in Spark functions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketmill.schema import DEFAULT_TEAM, TEAM_BY_REQUEST_TYPE, TICKET_FIELDS

# Fixed value: date, time and zone must all be written out.
FULL_ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})\z"


def event_time(text: Column) -> Column:
    """ISO-8601 text to an instant; unreadable text becomes null, also under ANSI mode."""
    return F.try_to_timestamp(text)


def full_iso_time(text: Column) -> Column:
    """True where the text spells a full date, time and zone."""
    return text.rlike(FULL_ISO_PATTERN)


def is_ticket_time(text: Column) -> Column:
    """True where strict mode accepts the text as a creation time."""
    return full_iso_time(text) & event_time(text).isNotNull()


def team_for(
    request_type: Column,
    teams: Mapping[str, str] = TEAM_BY_REQUEST_TYPE,
    default: str = DEFAULT_TEAM,
) -> Column:
    """Support team of a request type: exact, case-sensitive match, never null."""
    if not teams:
        return F.lit(default)
    entries = [F.lit(part) for pair in teams.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), request_type), F.lit(default))


def ticket_json() -> Column:
    """The six ticket columns of a DataFrame as one JSON object."""
    return F.to_json(F.struct(*TICKET_FIELDS))


def rejection_reason(value: Column, ticket: Column) -> Column:
    """Why strict mode refuses a record, or null for a valid one.

    ``value`` is the record payload and ``ticket`` the struct read from it. A
    record gets the first reason that applies.
    """
    fields = {name: ticket.getField(name) for name in TICKET_FIELDS}
    reason = F.when(value.isNull(), "null_value").when(
        F.coalesce(*fields.values()).isNull(), "no_ticket_fields"
    )
    for name, field in fields.items():
        reason = reason.when(field.isNull(), f"missing_{name}")
    return reason.when(~is_ticket_time(fields["created_at"]), "bad_created_at")


def typed_rejection_reason(value: Column, fields: Column) -> Column:
    """Why strict mode with types refuses a record, or null for a valid one.

    ``fields`` are the payload's top-level fields as variants, null where it isn't an
    object. Beside the reasons of ``rejection_reason``, a field that isn't text and a
    field that tickets don't have are refused. JSON null counts as missing.
    """
    own = {name: F.try_element_at(fields, F.lit(name)) for name in TICKET_FIELDS}
    kinds = {name: F.schema_of_variant(field) for name, field in own.items()}
    given = {name: own[name].isNotNull() & (kinds[name] != "VOID") for name in own}
    reason = F.when(value.isNull(), "null_value").when(
        fields.isNull() | ~reduce(Column.__or__, given.values()), "no_ticket_fields"
    )
    for name in own:
        reason = reason.when(~given[name], f"missing_{name}").when(kinds[name] != "STRING", f"wrong_type_{name}")
    known = F.array(*[F.lit(name) for name in TICKET_FIELDS])
    reason = reason.when(F.size(F.array_except(F.map_keys(fields), known)) > 0, "unknown_field")
    return reason.when(~is_ticket_time(F.try_variant_get(own["created_at"], "$", "string")), "bad_created_at")
