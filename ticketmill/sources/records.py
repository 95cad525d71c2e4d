"""Files that stand in for a topic, and the enriched table as a source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from ticketmill.schema import (
    ACCEPTED,
    CHECKED_SCHEMA,
    ENRICHED_SCHEMA,
    RECORD_SCHEMA,
    REJECT_COLUMNS,
    REJECTED,
)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECORD_SCHEMA).parquet(path)


def stream_records(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Replay record files as a stream, starting from every file already there."""
    reader = spark.readStream.schema(RECORD_SCHEMA)
    return _limited(reader, max_files_per_trigger).parquet(path)


def stream_enriched(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Follow the enriched table.

    The table's commit log hides files of unfinished batches. Without a limit a micro-batch
    takes all whole ingest batches that are new. With one, a query that starts late works
    through the table in the order of its files and never takes more at a time; files of
    one ingest batch may then fall into different micro-batches, which matters if their
    times lie further apart than the watermark.
    """
    reader = spark.readStream.schema(_by_day(ENRICHED_SCHEMA))
    return _limited(reader, max_files_per_trigger).parquet(path).select(*ENRICHED_SCHEMA.names)


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    """The enriched table with its partition column ``ingest_day``."""
    return spark.read.schema(_by_day(ENRICHED_SCHEMA)).parquet(path)


def stream_accepted(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Follow the accepted tickets of a checked table, as ``stream_enriched`` does; rejects aren't read."""
    reader = _limited(spark.readStream.schema(CHECKED_SCHEMA), max_files_per_trigger)
    accepted = reader.parquet(path).filter(F.col("verdict") == ACCEPTED)
    return accepted.select(*ENRICHED_SCHEMA.names)


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    """Accepted tickets of a checked table."""
    checked = spark.read.schema(CHECKED_SCHEMA).parquet(path)
    return checked.filter(F.col("verdict") == ACCEPTED).select(*ENRICHED_SCHEMA.names, "ingest_day")


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Refused records of a checked table, each with its reason and untouched payload."""
    checked = spark.read.schema(CHECKED_SCHEMA).parquet(path)
    return checked.filter(F.col("verdict") == REJECTED).select(*REJECT_COLUMNS, "ingest_day")


def _by_day(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField("ingest_day", T.DateType())])


def _limited(reader: DataStreamReader, max_files_per_trigger: int | None) -> DataStreamReader:
    if max_files_per_trigger:
        return reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader
