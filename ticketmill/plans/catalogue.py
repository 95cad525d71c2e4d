"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the whole ``events`` table.

Each query turns every event into a ticket, encodes it as a topic record and runs
the library on the records. Times leave as text, so that results compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketmill import operators as ops
from ticketmill.plans.job import JobConfig, catch_up, enriched_tickets
from ticketmill.schema import BY_PRIORITY_TARGET, BY_TYPE_TARGET, ENRICHED_SCHEMA, ENRICHED_TARGET, TICKET_FIELDS
from ticketmill.session import pin_utc, scratch_dir
from ticketmill.sinks import (
    EXPORTS,
    BatchExporter,
    ClientSequencer,
    LateTickets,
    latest_counts,
    read_export,
    read_totals,
)
from ticketmill.sources import (
    event_records,
    event_tickets,
    read_enriched,
    read_events,
    read_records,
    stream_events,
    stream_records,
    ticket_records,
)
from ticketmill.streaming import (
    start_batches,
    start_enriched_table,
    start_exports,
    start_window_changes,
    start_window_table,
    wait_for,
)
from ticketmill.streaming import open_windows as read_open_windows
from ticketmill.streaming.queries import ONCE, PRIORITY_KEYS, TYPE_KEYS

Query = Callable[[SparkSession, str], DataFrame]

_REGISTERED: dict[str, Query] = {}

COUNT = "ticket_count"


def _query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_utc(spark)
        return function(spark, sf_dir)

    _REGISTERED[function.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_REGISTERED)


# --- inputs and output forms --------------------------------------------------


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_records(read_events(spark, sf_dir))


def _record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_records(stream_events(spark, sf_dir))


# Here the payload is computed, not stored, so parse_once has a second use: it keeps that
# computation in generated code, while merged into the projection of the JSON parse it
# would be interpreted. On stored records only time windows need it.


def _parsed(records: DataFrame) -> DataFrame:
    return ops.parse_tickets(records, parse_once=True)


def _enriched(records: DataFrame) -> DataFrame:
    return enriched_tickets(records, parse_once=True)


def _tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(_records(spark, sf_dir))


def _ticket_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(_record_stream(spark, sf_dir))


def _time_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(column)


def _ticket_text(tickets: DataFrame, *more: str) -> DataFrame:
    """Ticket columns with times as text, without the processing time."""
    texts = [_time_text(c) if c == "created_at" else F.col(c) for c in TICKET_FIELDS]
    return tickets.select(*texts, _time_text("kafka_timestamp"), *more)


def _window_text(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    form = "yyyy-MM-dd HH:mm:ss"
    return counts.select(
        F.date_format("window.start", form).alias("window_start"),
        F.date_format("window.end", form).alias("window_end"),
        *keys,
        COUNT,
    )


def _tagged(results: dict[str, DataFrame]) -> DataFrame:
    """Results with one or two key columns stacked under their names."""
    parts = []
    for name, result in results.items():
        keys = [c for c in result.columns if c != COUNT]
        texts = [F.col(c).cast("string") for c in keys] + [F.lit(None).cast("string")]
        parts.append(
            result.select(
                F.lit(name).alias("target"),
                texts[0].alias("key"),
                texts[1].alias("detail"),
                COUNT,
            )
        )
    return reduce(DataFrame.unionByName, parts)


# --- scan, parse, enrich, validate ----------------------------------------------


@_query
def scan_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming scan of the keyed records: what arrived per key and when."""
    out = scratch_dir(spark, "scan_records")
    scanned = _record_stream(spark, sf_dir).select(
        F.col("key").cast("string").alias("client_id"), "timestamp"
    )
    wait_for(
        scanned.writeStream.format("parquet")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(**ONCE)
        .start(f"{out}/data")
    )
    return (
        spark.read.schema("client_id STRING, timestamp TIMESTAMP")
        .parquet(f"{out}/data")
        .groupBy("client_id")
        .agg(
            F.count("*").alias("record_count"),
            F.min("timestamp").alias("first_time"),
            F.max("timestamp").alias("last_time"),
        )
        .select("client_id", "record_count", _time_text("first_time"), _time_text("last_time"))
    )


@_query
def parse_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ticket_text(_parsed(_records(spark, sf_dir)))


@_query
def enrich_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ticket_text(_tickets(spark, sf_dir), "assigned_team")


@_query
def enrich_team_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enrichment with the team mapping as a joined table."""
    tickets = _parsed(_records(spark, sf_dir))
    enriched = ops.enrich_tickets_from_table(tickets, ops.team_table(spark))
    return _ticket_text(enriched, "assigned_team")


def damaged_payload() -> Column:
    """Ticket JSON, damaged in seven ways by the last digit of the event id."""
    digit = F.col("event_id") % 10
    created_at = (
        F.when(digit == 3, F.lit("not a date"))
        .when(digit == 5, F.date_format("ts", "yyyy-MM-dd"))
        .when(digit == 6, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+01:00'"))
        .when(digit == 7, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.col("created_at"))
    )
    fields = [created_at.alias(c) if c == "created_at" else F.col(c) for c in TICKET_FIELDS]
    return (
        F.when(digit == 1, F.lit("not json"))
        .when(digit == 2, F.lit(None).cast("string"))
        .when(digit == 4, F.to_json(F.struct("ticket_id")))
        .otherwise(F.to_json(F.struct(*fields)))
    )


def _damaged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_records(read_events(spark, sf_dir), damaged_payload())


@_query
def parse_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parity mode on damaged records: every record stays, with null columns."""
    tickets = _enriched(_damaged_records(spark, sf_dir))
    return _ticket_text(tickets, "assigned_team")


@_query
def validate_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict mode on damaged records: the accepted tickets."""
    return _ticket_text(ops.accepted_tickets(_damaged_records(spark, sf_dir)))


@_query
def rejected_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict mode on damaged records: the refused ones, each with its reason."""
    return ops.rejected_records(_damaged_records(spark, sf_dir)).select(
        "offset", F.col("key").cast("string").alias("client_id"), "reject_reason"
    )


@_query
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        ops.rejected_records(_damaged_records(spark, sf_dir))
        .groupBy("reject_reason")
        .agg(F.count("*").alias("record_count"))
    )


def mistyped_payload() -> Column:
    """Ticket JSON with fields of other types, too few or too many, by the last digit of the event id."""
    digit = F.col("event_id") % 10
    number = F.get_json_object("request", "$.k").cast("int")
    changed = {
        1: {"priority": number},
        3: {"request": F.struct(number.alias("k"))},
        4: {"client_id": F.lit(True)},
        5: {"request_type": F.array("request_type")},
        6: {"priority": F.lit(None).cast("string")},
    }

    def payload(fields: dict[str, Column], *more: Column) -> Column:
        return F.to_json(F.struct(*[fields.get(name, F.col(name)).alias(name) for name in TICKET_FIELDS], *more))

    value = F.when(digit == 2, payload({}, F.lit("mail").alias("channel")))
    for at, fields in changed.items():
        value = value.when(digit == at, payload(fields))
    return value.otherwise(payload({}))


@_query
def reject_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict mode with types on records whose fields aren't all text: the refused ones, each with its reason."""
    records = event_records(read_events(spark, sf_dir), mistyped_payload())
    return ops.rejected_records(records, typed=True).select(
        "offset", F.col("key").cast("string").alias("client_id"), "reject_reason"
    )


# --- whole-table counts ---------------------------------------------------------


@_query
def agg_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.count_by_type(_tickets(spark, sf_dir))


@_query
def agg_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.count_by_priority(_tickets(spark, sf_dir))


@_query
def agg_hourly_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.count_by_hour(_tickets(spark, sf_dir))


@_query
def agg_by_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.count_by_client(_tickets(spark, sf_dir))


@_query
def agg_by_client_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every client's place by its number of tickets; equal numbers go by client."""
    counts = ops.count_by_client(_tickets(spark, sf_dir))
    order = [F.desc(COUNT), F.col("client_id")]
    return ops.rank_rows(counts, order, scratch_dir(spark, "agg_by_client_ranked"))


@_query
def top_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.top_clients(_tickets(spark, sf_dir))


@_query
def top_clients_of_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``top_clients``, over a stored table: only clients that can be among the first are counted."""
    out = scratch_dir(spark, "top_clients_of_many")
    stored = _tickets(spark, sf_dir).select("client_id")
    stored.write.parquet(f"{out}/clients")
    return ops.top_clients_of_many(spark.read.schema(stored.schema).parquet(f"{out}/clients"), f"{out}/cells")


@_query
def batch_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Needs no field of the ticket, so without the explode nothing is parsed at all."""
    return ops.row_count(enriched_tickets(_records(spark, sf_dir)))


@_query
def rollup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four whole-table counts from a single pass."""
    return ops.rollup_counts(_tickets(spark, sf_dir))


# --- event-time windows ---------------------------------------------------------


@_query
def window_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = _tickets(spark, sf_dir)
    return _window_text(ops.window_counts_by_type(tickets), TYPE_KEYS)


@_query
def window_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = _tickets(spark, sf_dir)
    return _window_text(ops.window_counts_by_priority(tickets), PRIORITY_KEYS)


def _closed_windows(spark: SparkSession, sf_dir: str, name: str, keys: Sequence[str]) -> DataFrame:
    out = scratch_dir(spark, name)
    tickets = _ticket_stream(spark, sf_dir)
    wait_for(
        start_window_table(tickets, keys, f"{out}/data", f"{out}/checkpoint", name, trigger=ONCE)
    )
    return _window_text(spark.read.parquet(f"{out}/data"), keys)


def _changed_windows(
    spark: SparkSession, sf_dir: str, name: str, keys: Sequence[str]
) -> DataFrame:
    out = scratch_dir(spark, name)
    tickets = _ticket_stream(spark, sf_dir)
    wait_for(
        start_window_changes(tickets, keys, f"{out}/data", f"{out}/checkpoint", name, trigger=ONCE)
    )
    return _window_text(latest_counts(spark, f"{out}/data", *keys), keys)


@_query
def stream_by_type_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _closed_windows(spark, sf_dir, "stream_by_type_append", TYPE_KEYS)


@_query
def stream_by_priority_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _closed_windows(spark, sf_dir, "stream_by_priority_append", PRIORITY_KEYS)


@_query
def stream_by_type_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changed_windows(spark, sf_dir, "stream_by_type_update", TYPE_KEYS)


@_query
def stream_by_priority_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changed_windows(spark, sf_dir, "stream_by_priority_update", PRIORITY_KEYS)


@_query
def open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that a bounded run in append mode leaves open, from the state in its checkpoint."""
    out = scratch_dir(spark, "open_windows")
    tickets = _ticket_stream(spark, sf_dir)
    checkpoint = f"{out}/checkpoint"
    wait_for(start_window_table(tickets, PRIORITY_KEYS, f"{out}/data", checkpoint, "open_windows", trigger=ONCE))
    return _window_text(read_open_windows(spark, checkpoint, PRIORITY_KEYS), PRIORITY_KEYS)


PARTS = 3


def _time_cuts(events: DataFrame) -> list[Column] | None:
    """Bounds of three parts of equal length in time: cuts[i] <= ts < cuts[i + 1]. None if no event has a time."""
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    if first is None:
        return None
    micros = (last - first) // timedelta(microseconds=1) + 1
    steps = [timedelta(microseconds=-(-micros * i // PARTS)) for i in range(PARTS + 1)]
    return [F.lit(first + step).cast("timestamp_ntz") for step in steps]


def _between(events: DataFrame, cuts: list[Column] | None, start: int, end: int) -> DataFrame:
    """Events of some parts; the bounds reach the Parquet scan. Events without a time belong to the first part."""
    if cuts is None:
        return events if start <= 0 else events.filter(F.lit(False))
    inside = (F.col("ts") >= cuts[max(start, 0)]) & (F.col("ts") < cuts[end])
    return events.filter(inside | F.col("ts").isNull() if start <= 0 else inside)


def _arriving_late(spark: SparkSession, sf_dir: str, out: str) -> Iterator[DataFrame]:
    """The tickets of a topic, streamed anew after each of three arrivals.

    Tickets arrive in three parts by time, critical ones one part late (those of
    the last part in time).
    """
    events = read_events(spark, sf_dir)
    cuts = _time_cuts(events)
    critical = F.col("priority") == "critical"
    for part in range(PARTS):
        # Without a time a ticket is in the first part, which is part 0's own and before part 1.
        on_time = F.lit(part == 0)
        if cuts is not None:
            on_time = F.coalesce(F.col("ts") >= cuts[part], on_time)
        due = on_time & ~critical | ~on_time & critical
        if part == PARTS - 1:
            due = due | critical
        tickets = event_tickets(_between(events, cuts, part - 1, part + 1)).filter(due)
        ticket_records(tickets).write.mode("append").parquet(f"{out}/topic")
        yield _enriched(stream_records(spark, f"{out}/topic"))


@_query
def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows of a stream that is restarted twice and gets late tickets.

    A late ticket counts only while its window is open.
    """
    out = scratch_dir(spark, "stream_late_data")
    for arrived in _arriving_late(spark, sf_dir, out):
        wait_for(
            start_window_table(
                arrived,
                PRIORITY_KEYS,
                f"{out}/data",
                f"{out}/checkpoint",
                "stream_late_data",
                trigger=ONCE,
            )
        )
    return _window_text(spark.read.parquet(f"{out}/data"), PRIORITY_KEYS)


@_query
def late_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tickets that ``stream_late_data`` drops, kept from the same arrivals."""
    out = scratch_dir(spark, "late_tickets")
    sink = LateTickets(f"{out}/late")
    for arrived in _arriving_late(spark, sf_dir, out):
        wait_for(start_batches(arrived, sink, f"{out}/checkpoint", "late_tickets", ONCE))
    return _ticket_text(sink.read(spark, ENRICHED_SCHEMA), "assigned_team")


# --- sinks ------------------------------------------------------------------------


@_query
def sink_enriched_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "sink_enriched_parquet")
    tickets = _ticket_stream(spark, sf_dir)
    wait_for(start_enriched_table(tickets, f"{out}/data", f"{out}/checkpoint", trigger=ONCE))
    return _ticket_text(spark.read.schema(tickets.schema).parquet(f"{out}/data"), "assigned_team")


def _exported(spark: SparkSession, sf_dir: str, name: str, mode: str = "last_batch") -> str:
    out = scratch_dir(spark, name)
    exporter = BatchExporter(f"{out}/data", mode=mode)
    tickets = _ticket_stream(spark, sf_dir)
    wait_for(start_exports(tickets, exporter, f"{out}/checkpoint", trigger=ONCE, name=name))
    return f"{out}/data"


@_query
def sink_batch_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _exported(spark, sf_dir, "sink_batch_exports")
    names = [name for name, export in EXPORTS.items() if export.format == "parquet"]
    return _tagged({name: read_export(spark, root, name) for name in names})


@_query
def sink_json_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _exported(spark, sf_dir, "sink_json_exports")
    names = [name for name, export in EXPORTS.items() if export.format == "json"]
    return _tagged({name: read_export(spark, root, name) for name in names})


@_query
def sink_cumulative_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals after three micro-batches, each a part of the tickets."""
    root = f"{scratch_dir(spark, 'sink_cumulative_exports')}/data"
    exporter = BatchExporter(root, mode="cumulative")
    events = read_events(spark, sf_dir)
    cuts = _time_cuts(events)
    for part in range(PARTS):
        batch = event_records(_between(events, cuts, part, part + 1))
        exporter(_enriched(batch), part)
    return _tagged({name: read_export(spark, root, name) for name in EXPORTS})


@_query
def stream_total_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _exported(spark, sf_dir, "stream_total_by_hour", "cumulative")
    return read_totals(spark, root, "by_hour")


@_query
def stream_total_by_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _exported(spark, sf_dir, "stream_total_by_client", "cumulative")
    return read_totals(spark, root, "by_client")


def _arriving_in_parts(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, Callable[[int], DataFrame]]:
    """A scratch folder, and a function that lets one more part of the events arrive and streams the records.

    A table in order of time, or in few row groups, has a part's events in few tasks. They are dealt
    out before they become records, so that the topic's files are of one size.
    """
    out = scratch_dir(spark, name)
    events = read_events(spark, sf_dir)
    cuts = _time_cuts(events)

    def arrive(part: int) -> DataFrame:
        dealt = _between(events, cuts, part, part + 1).repartition("event_id", "ts")
        event_records(dealt).write.mode("append").parquet(f"{out}/topic")
        return stream_records(spark, f"{out}/topic")

    return out, arrive


@_query
def stream_restart_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job run once per part on one checkpoint: what the table, the windows and the exports hold at the end."""
    out, arrive = _arriving_in_parts(spark, sf_dir, "stream_restart_totals")
    config = JobConfig(
        output_path=f"{out}/data", checkpoint_path=f"{out}/checkpoints", export_mode="cumulative"
    )
    for part in range(PARTS):
        catch_up(spark, arrive(part), config)
    windows = latest_counts(spark, f"{out}/data/{BY_PRIORITY_TARGET}", *PRIORITY_KEYS)
    return _tagged(
        {
            "enriched_tickets": ops.count_by(read_enriched(spark, f"{out}/data/{ENRICHED_TARGET}"), "priority"),
            "tickets_by_priority": windows.groupBy("priority").agg(F.sum(COUNT).alias(COUNT)),
            "batch_aggregations": read_export(spark, f"{out}/data", "agg_by_priority"),
        }
    )


@_query
def job_bookkeeping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job does beside its results: query names, empty batches, processing times per micro-batch."""
    out, arrive = _arriving_in_parts(spark, sf_dir, "job_bookkeeping")
    names: set[str] = set()
    exporter = BatchExporter(f"{out}/exports")
    for part in range(PARTS):
        tickets = _enriched(arrive(part))
        queries = [
            start_enriched_table(tickets, f"{out}/table", f"{out}/checkpoints/table", ONCE),
            start_exports(tickets, exporter, f"{out}/checkpoints/exports", ONCE),
        ]
        names |= {query.name for query in queries}
        wait_for(*queries)
    published = read_export(spark, f"{out}/exports", "agg_by_priority")
    exporter(_enriched(_records(spark, sf_dir)).filter(F.lit(False)), PARTS + 1)
    after_empty = read_export(spark, f"{out}/exports", "agg_by_priority")
    table = read_enriched(spark, f"{out}/table")
    facts = {
        "enriched_rows": table.count(),
        "rows_without_processing_time": table.filter(F.col("processing_timestamp").isNull()).count(),
        "processing_times": table.select("processing_timestamp").distinct().count(),
        "named_queries": len(names & {"enriched_tickets", "batch_aggregations"}),
        "changed_by_empty_batch": published.exceptAll(after_empty).count(),
    }
    return reduce(
        DataFrame.unionByName,
        [
            spark.range(0, 1, 1, 1).select(F.lit(name).alias("fact"), F.lit(value).cast("bigint").alias("value"))
            for name, value in facts.items()
        ],
    )


@_query
def client_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ticket's number among its client's, after three micro-batches."""
    out, arrive = _arriving_in_parts(spark, sf_dir, "client_sequence")
    sequencer = ClientSequencer(f"{out}/numbered")
    for part in range(PARTS):
        wait_for(start_batches(_enriched(arrive(part)), sequencer, f"{out}/checkpoint", "client_sequence", ONCE))
    return sequencer.read(spark, ENRICHED_SCHEMA).select("ticket_id", "client_id", "sequence")


@_query
def publish_keyed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed records written client by client, then read back and parsed."""
    out = scratch_dir(spark, "publish_keyed_json")
    events = read_events(spark, sf_dir)
    tickets = ops.partition_by_client(event_tickets(events), tell_apart=["event_id"])
    ops.keyed_records(tickets).write.parquet(f"{out}/topic")
    records = read_records(spark, f"{out}/topic")
    parsed = ops.decode_records(records, "key")
    return parsed.select(
        F.col("key").cast("string").alias("key"), *[f"ticket.{name}" for name in TICKET_FIELDS]
    )


@_query
def partition_by_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per client: tickets written, and whether its files follow each other with the tickets in order."""
    out = scratch_dir(spark, "partition_by_client")
    tickets = event_tickets(read_events(spark, sf_dir))
    placed = ops.partition_by_client(tickets, tell_apart=["event_id"])
    placed.select(*TICKET_FIELDS).write.parquet(f"{out}/data")
    written = spark.read.schema("client_id STRING, created_at STRING, ticket_id STRING").parquet(f"{out}/data")
    place = F.struct(F.coalesce("created_at", F.lit("")).alias("time"), F.col("ticket_id").alias("ticket"))
    files = written.groupBy("client_id", F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("n"), F.min(place).alias("first"), F.max(place).alias("last")
    )
    # Files are named in the order of the partitions. A client's files must be numbered
    # without a gap, and none may start before the one before it ends.
    numbered = files.withColumn("part", F.regexp_extract("file", r"part-(\d+)", 1).cast("int"))
    before = F.lag("last").over(Window.partitionBy("client_id").orderBy("part"))
    return (
        numbered.withColumn("before", before)
        .groupBy("client_id")
        .agg(
            F.sum("n").alias(COUNT),
            F.count_if(F.col("before") > F.col("first")).alias("order_breaks"),
            (F.max("part") - F.min("part") + 1 - F.count("*")).alias("gaps"),
        )
    )


@_query
def concurrent_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job: ingest, then three queries side by side; what each one counted."""
    out = scratch_dir(spark, "concurrent_queries")
    config = JobConfig(output_path=f"{out}/data", checkpoint_path=f"{out}/checkpoints")
    catch_up(spark, _record_stream(spark, sf_dir), config)

    def window_total(name: str, keys: Sequence[str]) -> DataFrame:
        counts = latest_counts(spark, f"{out}/data/{name}", *keys)
        return counts.groupBy(*keys).agg(F.sum(COUNT).alias(COUNT))

    enriched = read_enriched(spark, f"{out}/data/{ENRICHED_TARGET}")
    return _tagged(
        {
            "enriched_tickets": ops.count_by(enriched, "assigned_team"),
            "tickets_by_type": window_total(BY_TYPE_TARGET, TYPE_KEYS),
            "tickets_by_priority": window_total(BY_PRIORITY_TARGET, PRIORITY_KEYS),
            "batch_aggregations": read_export(spark, f"{out}/data", "agg_hourly_volume"),
        }
    )
