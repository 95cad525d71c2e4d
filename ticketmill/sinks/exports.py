"""The per-micro-batch exports: four Parquet targets and two JSON targets.

One pass over the batch writes its rollup as a run of changes (see ``runs``); all targets
are written from it, or from the totals of all runs. Each published micro-batch has folders of its own, numbered in sequence, and one
row in ``_published`` makes them visible once every target is complete. So a crash
never shows targets of different batches, and a reader keeps what it opened: folders
are removed by age only, never written again once published.
"""

from __future__ import annotations

import json
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Literal

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.operators.counts import COUNT, ROLLUP_COLUMNS, ROLLUP_KEYS, rollup_counts
from ticketmill.schema import TOP_CLIENTS
from ticketmill.sinks.folders import delete_folder
from ticketmill.sinks.owner import LostCheckpointError, record_owner, running_query_id
from ticketmill.sinks.runs import Run, Runs, RunStore

# Running totals are merged in so many parts by client, and one part for all other counts.
CLIENT_BUCKETS = 32
OTHER_BUCKET = 0
# Published folders stay readable for at least so long after the next one.
RETENTION_SECONDS = 3600

ROLLUP_SCHEMA = T.StructType(
    [
        T.StructField("target", T.StringType()),
        T.StructField("request_type", T.StringType()),
        T.StructField("assigned_team", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("client_id", T.StringType()),
        T.StructField(COUNT, T.LongType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)
PUBLISHED_SCHEMA = (
    "batch_id BIGINT, query_id STRING, ticket_count BIGINT, published_at DOUBLE, "
    "runs MAP<INT, ARRAY<STRUCT<number: BIGINT, size: BIGINT>>>, sequence BIGINT"
)


@dataclass(frozen=True)
class Export:
    """One exported result: which rollup rows, in which format and order."""

    source: str
    format: Literal["parquet", "json"]
    by_count: bool = True
    top: int | None = None

    @property
    def keys(self) -> tuple[str, ...]:
        return ROLLUP_KEYS[self.source]

    @property
    def order(self) -> list[Column]:
        keys = [F.col(key) for key in self.keys]
        return [F.desc(COUNT), *keys] if self.by_count else keys

    def schema(self) -> T.StructType:
        return T.StructType([ROLLUP_SCHEMA[name] for name in (*self.keys, COUNT)])


# Folder names of the exported results.
EXPORTS = {
    "agg_by_type": Export("by_type", "parquet"),
    "agg_by_priority": Export("by_priority", "parquet"),
    "agg_hourly_volume": Export("by_hour", "parquet", by_count=False),
    "agg_top_clients": Export("by_client", "parquet", top=TOP_CLIENTS),
    "json_by_type": Export("by_type", "json"),
    "json_by_priority": Export("by_priority", "json"),
}


@dataclass(frozen=True)
class Published:
    """A visible export: its number, where it came from, and the runs that its counts are the sums of."""

    sequence: int
    batch_id: int
    query_id: str | None
    published_at: float
    runs: Runs


def _all_published(spark: SparkSession, root: str) -> list[Published]:
    """What is visible, oldest first. The table has a row per export that isn't removed yet."""
    try:
        table = (
            spark.read.schema(PUBLISHED_SCHEMA)
            .option("ignoreMissingFiles", "true")
            .parquet(f"{root}/_published")
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    found = [
        Published(
            row.sequence,
            row.batch_id,
            row.query_id,
            row.published_at,
            {part: [Run(run.number, run.size) for run in runs] for part, runs in row.runs.items()},
        )
        for row in table.collect()
    ]
    return sorted(found, key=lambda one: one.sequence)


def _store(root: str) -> RunStore:
    return RunStore(f"{root}/_rollup", ROLLUP_SCHEMA, ("target", *ROLLUP_COLUMNS))


def _bucket() -> Column:
    """Part of the running totals that a rollup row belongs to."""
    part = F.pmod(F.xxhash64("client_id"), F.lit(CLIENT_BUCKETS)).cast("int") + 1
    return F.when(F.col("target") == "by_client", part).otherwise(F.lit(OTHER_BUCKET)).alias("bucket")


class BatchExporter:
    """A foreachBatch function that exports the counts of enriched tickets.

    mode ``last_batch``: each export covers the latest micro-batch only.
    mode ``cumulative``: each export covers every micro-batch so far. A batch adds its own
    counts as a run of changes and merges older runs of one part of the clients. The top list
    is updated from the clients of the batch and the list before it.

    ``in_place`` (last_batch only) writes ``<root>/<target>`` directly, for readers
    that expect plain folders; targets are then replaced one by one.

    The exports belong to the query that published first; another one is refused, since
    its batches are numbered anew.
    """

    def __init__(
        self,
        root: str,
        mode: Literal["last_batch", "cumulative"] = "last_batch",
        retention_seconds: float = RETENTION_SECONDS,
        in_place: bool = False,
    ) -> None:
        if mode not in ("last_batch", "cumulative"):
            raise ValueError(f"unknown export mode: {mode}")
        if retention_seconds < 0:
            raise ValueError("retention_seconds must not be negative")
        if in_place and mode == "cumulative":
            raise ValueError("cumulative exports need folders of their own; in_place has none")
        self.root = root.rstrip("/")
        self.mode = mode
        self.retention_seconds = retention_seconds
        self.in_place = in_place

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = running_query_id(spark)
        if query_id is not None:
            record_owner(spark, self.root, query_id)
        visible = _all_published(spark, self.root)
        last = visible[-1] if visible else None
        if last is not None and query_id == last.query_id:
            if batch_id < last.batch_id:
                raise LostCheckpointError(
                    f"batch {batch_id} after published batch {last.batch_id}: the checkpoint "
                    f"was reset but {self.root} still holds its results"
                )
            if self.mode == "cumulative" and batch_id == last.batch_id:
                return  # already published; only the stream's own commit was lost
        sequence = last.sequence + 1 if last else 0

        runs, tickets = self._write_rollup(rollup_counts(batch), sequence, last)
        if not runs:
            return  # an empty batch publishes nothing
        rollup = self._rollup(spark, runs, sequence, last)

        def write(name: str) -> None:
            path = f"{self.root}/{name}" if self.in_place else _export_path(self.root, name, sequence)
            result = self._result(rollup, EXPORTS[name], name, last)
            result.write.mode("overwrite").format(EXPORTS[name].format).save(path)

        # The results are small, so their jobs are all start-up time: run them together.
        # Each thread gets its own copy of the job's properties, so that stopping the
        # stream also cancels these jobs.
        with ThreadPoolExecutor(len(EXPORTS)) as pool:
            jobs = [pool.submit(inheritable_thread_target(spark)(write), name) for name in EXPORTS]
            for job in jobs:
                job.result()

        published_at = time.time()
        row = spark.range(0, 1, 1, 1).select(
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.lit(query_id).cast("string").alias("query_id"),
            F.lit(tickets).cast("bigint").alias(COUNT),
            F.lit(published_at).alias("published_at"),
            _runs_literal(runs).alias("runs"),
        )
        row.write.mode("overwrite").parquet(f"{self.root}/_published/sequence={sequence}")
        current = Published(sequence, batch_id, query_id, published_at, runs)
        self._remove_old(spark, [*visible, current])

    def _write_rollup(self, counts: DataFrame, sequence: int, last: Published | None) -> tuple[Runs, int]:
        """Write the rollup of a batch as a run; the runs that hold the counts from now on, none for an
        empty batch, and the number of its tickets."""
        own, merged = _own_run(sequence), _own_run(sequence) + 1
        store = _store(self.root)
        # Each ticket has one priority, so these counts add up to the tickets.
        tickets = F.when(F.col("target") == "by_priority", F.col(COUNT))
        bucket = F.lit(OTHER_BUCKET) if self.mode == "last_batch" else _bucket()
        parts = 1 if self.mode == "last_batch" else CLIENT_BUCKETS + 1
        sizes, sums = store.add(counts.withColumn("bucket", bucket), own, parts, tickets=tickets)
        before = last.runs if last and sizes and self.mode == "cumulative" else {}
        runs = {
            part: before.get(part, []) + ([Run(own, sizes[part])] if part in sizes else [])
            for part in {*before, *sizes}
        }
        return store.merge(counts.sparkSession, runs, merged) if before else runs, sums["tickets"]

    def _rollup(self, spark: SparkSession, runs: Runs, sequence: int, last: Published | None) -> dict[str, DataFrame]:
        """The counts that this batch exports, by target: of clients only those that it changed."""
        store = _store(self.root)
        if self.mode == "last_batch" or last is None:
            return dict.fromkeys(ROLLUP_KEYS, store.read(spark, runs))
        own = {part: [Run(_own_run(sequence), 0)] for part in runs if part != OTHER_BUCKET}
        changed = store.read(spark, own).select(F.col("client_id").alias("changed"))
        # Only the rows of changed clients are grouped.
        clients = store.read(spark, runs, own).join(
            changed, F.col("client_id").eqNullSafe(F.col("changed")), "left_semi"
        )
        others = store.totals(store.read(spark, runs, [OTHER_BUCKET]))
        return {name: store.totals(clients) if name == "by_client" else others for name in ROLLUP_KEYS}

    def _result(
        self, rollup: dict[str, DataFrame], export: Export, name: str, last: Published | None
    ) -> DataFrame:
        """An export's rows in order."""
        rows = rollup[export.source].filter(F.col("target") == export.source).select(*export.keys, COUNT)
        if not export.top:
            # The planner sizes the partitions of the sort: a small result is one file.
            return rows.orderBy(*export.order)
        if self.mode == "cumulative" and last is not None:
            # Counts only grow, so nobody enters the list but those on it and those that changed.
            listed = read_sequence(rows.sparkSession, self.root, name, last.sequence)
            changed = rows.select(F.col("client_id").alias("changed"))
            unchanged = listed.join(changed, F.col("client_id").eqNullSafe(F.col("changed")), "left_anti")
            rows = rows.unionByName(unchanged)
        return rows.orderBy(*export.order).limit(export.top).coalesce(1)

    def _remove_old(self, spark: SparkSession, visible: list[Published]) -> None:
        """Remove exports that were replaced longer than the retention ago."""
        limit = time.time() - self.retention_seconds
        # An export is replaced when the next one is published.
        old = [one for one, following in zip(visible, visible[1:]) if following.published_at < limit]
        if not old:
            return
        kept = {run.number for one in visible[len(old) :] for of_part in one.runs.values() for run in of_part}
        for one in old:
            delete_folder(spark, f"{self.root}/_published/sequence={one.sequence}")
            for name in EXPORTS:
                delete_folder(spark, _export_path(self.root, name, one.sequence))
        _store(self.root).keep_only(spark, kept, _own_run(old[-1].sequence) + 1)


def _runs_literal(runs: Runs) -> Column:
    kept = {part: [{"number": run.number, "size": run.size} for run in of_part] for part, of_part in runs.items()}
    # A JSON object has text keys.
    parsed = F.from_json(F.lit(json.dumps(kept)), "MAP<STRING, ARRAY<STRUCT<number: BIGINT, size: BIGINT>>>")
    return F.transform_keys(parsed, lambda part, _: part.cast("int"))


def _own_run(sequence: int) -> int:
    """Number of the run that an export's batch writes; the next one is that of its merge."""
    return 2 * sequence


def _export_path(root: str, name: str, sequence: int) -> str:
    return f"{root}/{name}/sequence={sequence}"


def _latest(spark: SparkSession, root: str) -> Published | None:
    visible = _all_published(spark, root)
    return visible[-1] if visible else None


def read_totals(spark: SparkSession, root: str, source: str) -> DataFrame:
    """The newest published count per key of one rollup target, e.g. ``by_client``; no rows if nothing is published."""
    last, store = _latest(spark, root), _store(root)
    rows = store.read(spark, last.runs if last else {}).filter(F.col("target") == source)
    return store.totals(rows).select(*ROLLUP_KEYS[source], COUNT)


def read_sequence(spark: SparkSession, root: str, name: str, sequence: int) -> DataFrame:
    export = EXPORTS[name]
    return spark.read.schema(export.schema()).format(export.format).load(_export_path(root, name, sequence))


def read_export(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest published result of one export, with its exact columns; no rows if nothing is published.

    It stays readable for the exporter's retention after it was replaced.
    """
    last = _latest(spark, root)
    if last is None:
        return spark.createDataFrame([], EXPORTS[name].schema())
    return read_sequence(spark, root, name, last.sequence)
