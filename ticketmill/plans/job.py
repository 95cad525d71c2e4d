"""The whole job: one record stream, four named queries."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ticketmill.operators import (
    accepted_tickets,
    checked_tickets,
    enrich_tickets,
    parse_tickets,
)
from ticketmill.schema import (
    BY_PRIORITY_TARGET,
    BY_TYPE_TARGET,
    CHECKED_TARGET,
    DEFAULT_OUTPUT,
    DEFAULT_SERVERS,
    ENRICHED_TARGET,
    EXPORTS_QUERY,
    TOPIC,
)
from ticketmill.session import build_session, pin_utc, shared_folder
from ticketmill.sinks import BatchExporter
from ticketmill.sources import stream_accepted, stream_enriched, stream_kafka
from ticketmill.streaming import (
    start_checked_table,
    start_enriched_table,
    start_exports,
    start_window_changes,
    start_window_table,
    wait_for,
)
from ticketmill.streaming.queries import (
    EVERY_EXPORT,
    EVERY_INGEST,
    ONCE,
    PRIORITY_KEYS,
    TYPE_KEYS,
    Trigger,
)


@dataclass(frozen=True)
class JobConfig:
    output_path: str
    # None: a folder under the session's spark.checkpoint.dir.
    checkpoint_path: str | None = None
    servers: str = DEFAULT_SERVERS
    topic: str = TOPIC
    fail_on_data_loss: bool = True
    max_offsets_per_trigger: int | None = None
    # More tasks than topic partitions: a hot client makes its topic partition hot.
    min_partitions: int | None = None
    # Refuse malformed records: accepted and refused ones go to one checked table.
    strict: bool = False
    # In strict mode also refuse fields that aren't text, and unknown ones.
    strict_types: bool = False
    # "table": records are read and parsed once, into the enriched table, and the
    # counting queries follow that table. "source": each query reads the records.
    fan_out: str = "table"
    # "update": log of changed counts. "append": final counts of closed windows.
    windows: str = "update"
    export_mode: str = "last_batch"
    exports_in_place: bool = False
    state_partitions: int | None = None
    # Bound of one micro-batch of the queries that follow the table, for late starts.
    max_files_per_trigger: int | None = None
    # Age at which files leave the table and its commit log, e.g. "90d"; None keeps all.
    table_retention: str | None = None
    ingest_trigger: Trigger = field(default_factory=lambda: EVERY_INGEST)
    export_trigger: Trigger = field(default_factory=lambda: EVERY_EXPORT)

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> JobConfig:
        def number(name: str) -> int | None:
            return int(env[name]) if env.get(name) else None

        return cls(
            servers=env.get("KAFKA_BROKER", DEFAULT_SERVERS),
            topic=env.get("TOPIC_NAME", TOPIC),
            output_path=env.get("OUTPUT_PATH", DEFAULT_OUTPUT),
            checkpoint_path=env.get("CHECKPOINT_PATH"),
            fail_on_data_loss=env.get("FAIL_ON_DATA_LOSS", "true").lower() == "true",
            max_offsets_per_trigger=number("MAX_OFFSETS_PER_TRIGGER"),
            min_partitions=number("MIN_PARTITIONS"),
            state_partitions=number("STATE_PARTITIONS"),
            max_files_per_trigger=number("MAX_FILES_PER_TRIGGER"),
            table_retention=env.get("TABLE_RETENTION"),
            strict=env.get("STRICT", "false").lower() == "true",
            strict_types=env.get("STRICT_TYPES", "false").lower() == "true",
            fan_out=env.get("FAN_OUT", "table"),
            windows=env.get("WINDOW_OUTPUT", "update"),
            export_mode=env.get("EXPORT_MODE", "last_batch"),
            exports_in_place=env.get("EXPORTS_IN_PLACE", "false").lower() == "true",
        )

    def table(self, name: str) -> str:
        return f"{self.output_path.rstrip('/')}/{name}"

    def __post_init__(self) -> None:
        if self.fan_out not in ("table", "source"):
            raise ValueError(f"unknown fan_out: {self.fan_out}")
        if self.windows not in ("update", "append"):
            raise ValueError(f"unknown windows mode: {self.windows}")
        if self.strict_types and not self.strict:
            raise ValueError("strict_types needs strict")


def enriched_tickets(
    records: DataFrame, strict: bool = False, parse_once: bool = False, strict_types: bool = False
) -> DataFrame:
    tickets = accepted_tickets(records, strict_types) if strict else parse_tickets(records, parse_once)
    return enrich_tickets(tickets)


def checkpoint_root(spark: SparkSession, config: JobConfig) -> str:
    if config.checkpoint_path:
        return config.checkpoint_path.rstrip("/")
    return f"{shared_folder(spark)}/ticketmill/{config.topic}"


def start_ingest(
    spark: SparkSession, records: DataFrame, config: JobConfig
) -> list[StreamingQuery]:
    """Start the query that fills the table: enriched tickets or, in strict mode, checked ones."""
    pin_utc(spark)
    target = CHECKED_TARGET if config.strict else ENRICHED_TARGET
    start = start_checked_table if config.strict else start_enriched_table
    rows = (
        enrich_tickets(checked_tickets(records, config.strict_types)) if config.strict else enriched_tickets(records)
    )
    return [
        start(
            rows,
            config.table(target),
            f"{checkpoint_root(spark, config)}/{target}",
            config.ingest_trigger,
            retention=config.table_retention,
        )
    ]


def start_counting(
    spark: SparkSession, records: DataFrame, config: JobConfig
) -> list[StreamingQuery]:
    """Start the two windowed counts and the batch exports."""
    pin_utc(spark)
    checkpoints = checkpoint_root(spark, config)
    if config.fan_out == "table":
        target = CHECKED_TARGET if config.strict else ENRICHED_TARGET
        follow = stream_accepted if config.strict else stream_enriched
        timed = tickets = follow(spark, config.table(target), config.max_files_per_trigger)
    else:
        timed = enriched_tickets(records, config.strict, parse_once=True, strict_types=config.strict_types)
        tickets = enriched_tickets(records, config.strict, strict_types=config.strict_types)

    start_windows = start_window_changes if config.windows == "update" else start_window_table
    queries = [
        start_windows(
            timed,
            keys,
            config.table(name),
            f"{checkpoints}/{name}",
            name,
            config.ingest_trigger,
            config.state_partitions,
        )
        for name, keys in ((BY_TYPE_TARGET, TYPE_KEYS), (BY_PRIORITY_TARGET, PRIORITY_KEYS))
    ]
    exporter = BatchExporter(
        config.output_path, mode=config.export_mode, in_place=config.exports_in_place
    )
    queries.append(
        start_exports(
            tickets, exporter, f"{checkpoints}/{EXPORTS_QUERY}", config.export_trigger
        )
    )
    return queries


def start_job(
    spark: SparkSession, records: DataFrame, config: JobConfig
) -> list[StreamingQuery]:
    """Start every query over a record stream and return them, ingest first.

    Starting the ingest creates the commit log of the enriched table, so the table can
    be followed right away.
    """
    return start_ingest(spark, records, config) + start_counting(spark, records, config)


def catch_up(spark: SparkSession, records: DataFrame, config: JobConfig) -> None:
    """Process what has arrived so far and return: first the ingest, then the counts.

    For scheduled runs. Run again, it continues where the last run ended.
    """
    bounded = replace(config, ingest_trigger=ONCE, export_trigger=ONCE)
    wait_for(*start_ingest(spark, records, bounded))
    wait_for(*start_counting(spark, records, bounded))


def run(config: JobConfig, spark: SparkSession | None = None) -> None:
    """Run until any query ends; a failed one ends the process with its error."""
    spark = spark or build_session()
    records = stream_kafka(
        spark,
        config.servers,
        config.topic,
        fail_on_data_loss=config.fail_on_data_loss,
        max_offsets_per_trigger=config.max_offsets_per_trigger,
        min_partitions=config.min_partitions,
    )
    spark.streams.resetTerminated()
    queries = start_job(spark, records, config)
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()


if __name__ == "__main__":
    run(JobConfig.from_env())
