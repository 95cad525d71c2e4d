"""Durable form of update mode: a log of changed counts per day and micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.operators.counts import COUNT
from ticketmill.sinks.folders import delete_folder, list_folders
from ticketmill.sinks.owner import record_owner, running_query_id

# Files a day's changed counts of a micro-batch are spread over, at most.
FILES_PER_DAY = 8


def change_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that logs the windowed counts a micro-batch changed.

    The log is partitioned by the day of the window and by batch. A batch delivered
    twice changes the same windows, so it overwrites its own partitions. The counts are
    spread by day and by a hash of the window and its keys: a backlog's counts of a day
    go to several tasks, and a trigger adds a few files, not one per state partition.

    The log belongs to the query that wrote it first. Another one is refused, because its
    batches are numbered anew.
    """

    def write(changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        query_id = running_query_id(spark)
        if query_id is not None:
            record_owner(spark, path, query_id)
        keys = [name for name in changed.columns if name not in ("window", COUNT)]
        (
            changed.withColumns(
                {
                    "day": F.to_date("window.start"),
                    "batch_id": F.lit(batch_id).cast("bigint"),
                }
            )
            .repartition("day", F.pmod(F.xxhash64("window", *keys), F.lit(FILES_PER_DAY)))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "batch_id")
            .parquet(path)
        )

    return write


def _schema(*keys: str) -> str:
    """All keys are ticket fields, hence text."""
    texts = "".join(f"{key} STRING, " for key in keys)
    return f"window STRUCT<start: TIMESTAMP, end: TIMESTAMP>, {texts}{COUNT} BIGINT, day DATE, batch_id BIGINT"


def read_changes(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """The log itself, compacted days included."""
    schema = _schema(*keys)

    def rows_of(folder: str) -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(folder)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return spark.createDataFrame([], schema)  # nothing has been logged, or compacted, so far
            raise

    log = rows_of(path)
    return log.unionByName(rows_of(f"{path}/_compacted").select(*log.columns))


def latest_counts(
    spark: SparkSession,
    path: str,
    *keys: str,
    first_day: date | None = None,
    last_day: date | None = None,
) -> DataFrame:
    """The current count per window and key: the entry of the latest batch wins.

    Only the folders of the wanted days are read.
    """
    changes = read_changes(spark, path, *keys)
    if first_day is not None:
        changes = changes.filter(F.col("day") >= F.lit(first_day))
    if last_day is not None:
        changes = changes.filter(F.col("day") <= F.lit(last_day))
    return changes.groupBy("window", *keys).agg(F.max_by(COUNT, "batch_id").alias(COUNT))


def compact_changes(spark: SparkSession, path: str, *keys: str, before: date) -> None:
    """Replace the entries of the days before ``before`` by their latest counts.

    Meant for days whose windows are closed, run from time to time. A run writes a day's
    latest counts, each with its batch, beside the log, in a folder named after the last
    batch they cover. Readers then see an entry twice, which changes no result. What a
    complete folder covers is removed by the *next* run, so that readers that had listed it
    can finish. Entries that come later carry higher batches; they count, and are folded
    in by a later run. A run that dies is simply run again.
    """
    for folder in list_folders(spark, path):
        if folder.startswith("day=") and date.fromisoformat(folder.removeprefix("day=")) < before:
            _compact_day(spark, path, folder, keys)


def _numbers(names: list[str], prefix: str) -> list[int]:
    return sorted(int(name.removeprefix(prefix)) for name in names if name.startswith(prefix))


def _compact_day(spark: SparkSession, path: str, folder: str, keys: tuple[str, ...]) -> None:
    compacted = f"{path}/_compacted/{folder}"
    complete = [
        number
        for number in _numbers(list_folders(spark, compacted), "upto=")
        if "_SUCCESS" in list_folders(spark, f"{compacted}/upto={number}")
    ]
    batches = _numbers(list_folders(spark, f"{path}/{folder}"), "batch_id=")
    covered = complete[-1] if complete else -1
    for number in batches:
        if number <= covered:
            delete_folder(spark, f"{path}/{folder}/batch_id={number}")
    for number in complete[:-1]:
        delete_folder(spark, f"{compacted}/upto={number}")
    if not batches or batches[-1] <= covered:
        return
    day = date.fromisoformat(folder.removeprefix("day="))
    (
        read_changes(spark, path, *keys)
        .filter(F.col("day") == F.lit(day))
        .groupBy("window", *keys)
        .agg(F.max_by(COUNT, "batch_id").alias(COUNT), F.max("batch_id").alias("batch_id"))
        .write.mode("overwrite")
        .parquet(f"{compacted}/upto={batches[-1]}")
    )
