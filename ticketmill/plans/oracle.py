"""The same results as ANSI SQL over the input tables, for comparison."""

from __future__ import annotations

TK = """
tk AS (
  SELECT event_id, user_id, ts, props,
         'TK-' || lpad(upper(hex(event_id)),
                       CAST(greatest(8, length(hex(event_id))) AS int), '0') AS ticket_id,
         'CLI-' || lpad(CAST(user_id AS varchar),
                        CAST(greatest(4, length(CAST(user_id AS varchar))) AS int),
                        '0') AS client_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at,
         props AS request,
         CASE WHEN event_id % 50 = 0 THEN 'autre'
              WHEN event_type = 'error' THEN 'incident_technique'
              WHEN event_type = 'view' THEN 'demande_information'
              WHEN event_type = 'signup' THEN 'demande_evolution'
              WHEN event_type = 'click' THEN 'maintenance'
              ELSE 'facturation' END AS request_type,
         CASE WHEN k % 10 = 0 THEN 'critical' WHEN k % 10 <= 2 THEN 'high'
              WHEN k % 10 <= 5 THEN 'low' ELSE 'medium' END AS priority
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS int) AS k FROM events)
)"""

TEAM = """CASE request_type WHEN 'incident_technique' THEN 'Equipe Infrastructure'
              WHEN 'demande_information' THEN 'Support Client N1'
              WHEN 'demande_evolution' THEN 'Equipe Produit'
              WHEN 'maintenance' THEN 'Equipe Operations'
              WHEN 'facturation' THEN 'Service Comptabilite'
              ELSE 'Support General' END"""

ENRICHED = f"""WITH {TK},
en AS (SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS kafka_timestamp,
              {TEAM} AS assigned_team FROM tk)"""

DAMAGED = f"""{ENRICHED},
damaged AS (
  SELECT event_id, client_id, kafka_timestamp, event_id % 10 AS digit, ts,
         CASE WHEN event_id % 10 IN (1, 2) THEN NULL ELSE ticket_id END AS ticket_id,
         CASE WHEN event_id % 10 IN (1, 2, 4) THEN NULL ELSE request END AS request,
         CASE WHEN event_id % 10 IN (1, 2, 4) THEN NULL ELSE request_type END AS request_type,
         CASE WHEN event_id % 10 IN (1, 2, 4) THEN NULL ELSE priority END AS priority,
         CASE WHEN event_id % 10 IN (1, 2, 4) THEN NULL ELSE client_id END AS parsed_client,
         CASE WHEN event_id % 10 IN (1, 2, 3, 4) THEN NULL
              WHEN event_id % 10 = 5 THEN date_trunc('day', ts)
              WHEN event_id % 10 = 6 THEN ts - INTERVAL '1 hour'
              WHEN event_id % 10 = 7 THEN date_trunc('second', ts)
              ELSE ts END AS parsed_ts
  FROM en),
reasons AS (
  SELECT *, CASE WHEN digit = 1 THEN 'no_ticket_fields' WHEN digit = 2 THEN 'null_value'
                 WHEN digit = 3 THEN 'bad_created_at' WHEN digit = 4 THEN 'missing_client_id'
                 -- an event without a time gives a ticket without that field
                 WHEN ts IS NULL THEN 'missing_created_at'
                 WHEN digit = 5 THEN 'bad_created_at' END AS reject_reason
  FROM damaged)"""

TICKET = "ticket_id, client_id, created_at, request, request_type, priority, kafka_timestamp"

DAMAGED_TICKET = """ticket_id, parsed_client AS client_id,
       strftime(parsed_ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at, request, request_type,
       priority, kafka_timestamp"""

TYPE_KEYS = "request_type, assigned_team"


def _windows(keys: str, closed: bool | None = None) -> str:
    """Windowed counts: of all windows, or only of those that are closed, or open, at the end."""
    wanted = "WHERE ts IS NOT NULL"
    if closed is not None:
        wanted += f""" AND bucket + INTERVAL '5 minutes' {"<=" if closed else ">"}
                (SELECT max(ts) FROM en) - INTERVAL '1 minute'"""
    return f"""{ENRICHED},
b AS (SELECT *, time_bucket(INTERVAL '5 minutes', ts) AS bucket FROM en)
SELECT strftime(bucket, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(bucket + INTERVAL '5 minutes', '%Y-%m-%d %H:%M:%S') AS window_end,
       {keys}, count(*) AS ticket_count
FROM b {wanted} GROUP BY bucket, {keys}"""


def _export(name: str) -> str:
    """One exported result in (target, key, detail, ticket_count) form."""
    if name.endswith("by_type"):
        keys = "request_type AS key, assigned_team AS detail"
    elif name.endswith("by_priority"):
        keys = "priority AS key, CAST(NULL AS varchar) AS detail"
    elif name == "agg_hourly_volume":
        keys = "CAST(hour(ts) AS varchar) AS key, CAST(NULL AS varchar) AS detail"
    else:
        keys = "client_id AS key, CAST(NULL AS varchar) AS detail"
    top = "ORDER BY ticket_count DESC, key LIMIT 10" if name == "agg_top_clients" else ""
    return f"""SELECT * FROM (SELECT '{name}' AS target, {keys}, count(*) AS ticket_count
FROM en GROUP BY ALL {top})"""


def _exports(*names: str) -> str:
    return f"{ENRICHED}\n" + "\nUNION ALL\n".join(_export(name) for name in names)


PARQUET_EXPORTS = ("agg_by_type", "agg_by_priority", "agg_hourly_volume", "agg_top_clients")
JSON_EXPORTS = ("json_by_type", "json_by_priority")

# A third is decided in whole microseconds; critical tickets arrive one third late.
# A ticket is dropped when its window was closed by the tickets of earlier arrivals.
ARRIVALS = f"""{ENRICHED},
bounds AS (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM en),
arrivals AS (
  SELECT en.*, time_bucket(INTERVAL '5 minutes', ts) AS bucket,
         least(2, ((epoch_us(ts) - low) * 3) // (high - low + 1)
                  + CASE WHEN priority = 'critical' THEN 1 ELSE 0 END) AS arrival
  FROM en, bounds),
seen AS (
  SELECT arrival + 1 AS arrival,
         max(max(ts)) OVER (ORDER BY arrival) - INTERVAL '1 minute' AS watermark
  FROM arrivals GROUP BY arrival)"""

LATE = f"""{ARRIVALS}
SELECT strftime(bucket, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(bucket + INTERVAL '5 minutes', '%Y-%m-%d %H:%M:%S') AS window_end,
       priority, count(*) AS ticket_count
FROM arrivals LEFT JOIN seen USING (arrival)
WHERE (watermark IS NULL OR bucket + INTERVAL '5 minutes' > watermark)
  AND bucket + INTERVAL '5 minutes' <= (SELECT max(ts) FROM en) - INTERVAL '1 minute'
GROUP BY bucket, priority"""


def oracle_sql() -> dict[str, str]:
    def grouped(keys: str) -> str:
        return f"{ENRICHED} SELECT {keys}, count(*) AS ticket_count FROM en GROUP BY ALL"

    top_clients = f"{grouped('client_id')} ORDER BY ticket_count DESC, client_id LIMIT 10"
    hourly = grouped("CAST(hour(ts) AS int) AS hour")
    enriched_rows = f"{ENRICHED} SELECT {TICKET}, assigned_team FROM en"
    return {
        "scan_records": f"""{ENRICHED} SELECT client_id, count(*) AS record_count,
       min(kafka_timestamp) AS first_time, max(kafka_timestamp) AS last_time
FROM en GROUP BY client_id""",
        "parse_tickets": f"{ENRICHED} SELECT {TICKET} FROM en",
        "enrich_team": enriched_rows,
        "enrich_team_table": enriched_rows,
        "parse_damaged": f"{DAMAGED} SELECT {DAMAGED_TICKET}, {TEAM} AS assigned_team FROM damaged",
        "validate_tickets": f"""{DAMAGED} SELECT {DAMAGED_TICKET} FROM reasons
WHERE reject_reason IS NULL""",
        "rejected_tickets": f"""{DAMAGED} SELECT event_id AS "offset", client_id, reject_reason
FROM reasons WHERE reject_reason IS NOT NULL""",
        "reject_reasons": f"""{DAMAGED} SELECT reject_reason, count(*) AS record_count
FROM reasons WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
        "reject_types": f"""{ENRICHED} SELECT * FROM (
  SELECT event_id AS "offset", client_id,
         CASE WHEN event_id % 10 = 4 THEN 'wrong_type_client_id'
              WHEN ts IS NULL THEN 'missing_created_at'
              WHEN event_id % 10 = 3 THEN 'wrong_type_request'
              WHEN event_id % 10 = 5 THEN 'wrong_type_request_type'
              WHEN event_id % 10 = 1 THEN 'wrong_type_priority'
              WHEN event_id % 10 = 6 THEN 'missing_priority'
              WHEN event_id % 10 = 2 THEN 'unknown_field' END AS reject_reason
  FROM en) WHERE reject_reason IS NOT NULL""",
        "agg_by_type": grouped(TYPE_KEYS),
        "agg_by_priority": grouped("priority"),
        "agg_hourly_volume": hourly,
        "agg_by_client": grouped("client_id"),
        "top_clients": top_clients,
        "top_clients_of_many": top_clients,
        "batch_row_count": f"{ENRICHED} SELECT count(*) AS ticket_count FROM en",
        "rollup_counts": f"""{ENRICHED}
SELECT CASE WHEN grouping(client_id) = 0 THEN 'by_client' WHEN grouping(hour) = 0 THEN 'by_hour'
            WHEN grouping(priority) = 0 THEN 'by_priority' ELSE 'by_type' END AS target,
       request_type, assigned_team, priority, hour, client_id, count(*) AS ticket_count
FROM (SELECT *, CAST(hour(ts) AS int) AS hour FROM en)
GROUP BY GROUPING SETS ((request_type, assigned_team), (priority), (hour), (client_id))""",
        "window_by_type": _windows(TYPE_KEYS),
        "window_by_priority": _windows("priority"),
        "stream_by_type_append": _windows(TYPE_KEYS, closed=True),
        "stream_by_priority_append": _windows("priority", closed=True),
        "stream_by_type_update": _windows(TYPE_KEYS),
        "stream_by_priority_update": _windows("priority"),
        "stream_late_data": LATE,
        "late_tickets": f"""{ARRIVALS} SELECT {TICKET}, assigned_team
FROM arrivals JOIN seen USING (arrival) WHERE bucket + INTERVAL '5 minutes' <= watermark""",
        "open_windows": _windows("priority", closed=False),
        "agg_by_client_ranked": f"""{ENRICHED} SELECT client_id, count(*) AS ticket_count,
       row_number() OVER (ORDER BY count(*) DESC, client_id) AS rank FROM en GROUP BY client_id""",
        "client_sequence": f"""{ENRICHED} SELECT ticket_id, client_id,
       row_number() OVER (PARTITION BY client_id ORDER BY ts NULLS FIRST, ticket_id) AS sequence FROM en""",
        "sink_enriched_parquet": enriched_rows,
        "sink_batch_exports": _exports(*PARQUET_EXPORTS),
        "sink_json_exports": _exports(*JSON_EXPORTS),
        "sink_cumulative_exports": _exports(*PARQUET_EXPORTS, *JSON_EXPORTS),
        "stream_total_by_hour": hourly,
        "stream_total_by_client": grouped("client_id"),
        "publish_keyed_json": f"""{ENRICHED} SELECT client_id AS key, ticket_id, client_id,
       created_at, request, request_type, priority FROM en""",
        "partition_by_client": f"""{ENRICHED} SELECT client_id, count(*) AS ticket_count,
       CAST(0 AS bigint) AS order_breaks, CAST(0 AS bigint) AS gaps FROM en GROUP BY client_id""",
        "stream_restart_totals": f"""{ENRICHED}
SELECT 'enriched_tickets' AS target, priority AS key, CAST(NULL AS varchar) AS detail,
       count(*) AS ticket_count FROM en GROUP BY ALL
UNION ALL SELECT 'tickets_by_priority', priority, NULL, count(*) FROM en WHERE ts IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'batch_aggregations', priority, NULL, count(*) FROM en GROUP BY ALL""",
        "job_bookkeeping": f"""{ENRICHED}
SELECT 'enriched_rows' AS fact, count(*) AS value FROM en
UNION ALL SELECT 'rows_without_processing_time', 0
-- one processing time per micro-batch: a third with no event makes none
UNION ALL SELECT 'processing_times', count(DISTINCT third) FROM (
  SELECT coalesce(((epoch_us(ts) - low) * 3) // (high - low + 1), 0) AS third FROM en,
         (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM en))
UNION ALL SELECT 'named_queries', 2
UNION ALL SELECT 'changed_by_empty_batch', 0""",
        "concurrent_queries": f"""{ENRICHED}
SELECT 'enriched_tickets' AS target, assigned_team AS key, CAST(NULL AS varchar) AS detail,
       count(*) AS ticket_count FROM en GROUP BY ALL
UNION ALL SELECT 'tickets_by_type', request_type, assigned_team, count(*) FROM en WHERE ts IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'tickets_by_priority', priority, NULL, count(*) FROM en WHERE ts IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'batch_aggregations', CAST(hour(ts) AS varchar), NULL, count(*)
FROM en GROUP BY ALL""",
    }
