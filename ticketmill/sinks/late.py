"""Tickets that came too late for their window, kept with the batch that brought them.

Windowed counts drop a ticket whose window was closed by the watermark of an earlier
micro-batch, and the engine's metric of dropped rows counts partial aggregates, not tickets.
Here the watermark is kept in the sink's own manifest: the latest event time of earlier
batches less the delay. So each batch is read once, its late tickets are written, and its
latest time is observed by that same write.

Which earlier batches count is a matter of how the engine's counts run. After a trigger
without new data, as at the end of every bounded run, all do (``lag`` 0). While batches with
data follow each other at once, the engine's rule lags by one batch: ``lag`` 1 is that rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.schema import WATERMARK_DELAY, WINDOW_LENGTH
from ticketmill.sinks.manifest import Manifest
from ticketmill.sinks.owner import record_owner, running_query_id

# Microseconds of a time before any ticket's, in the year 1.
EARLIEST = -62_135_000_000_000_000


class LateTickets:
    """A foreachBatch function that keeps the tickets which windowed counts of the same batches drop.

    A retried batch gives the same rows. Tickets without a time belong to no window and are never late.
    """

    def __init__(
        self, root: str, length: str = WINDOW_LENGTH, delay: str = WATERMARK_DELAY, lag: int = 0
    ) -> None:
        self.root = root.rstrip("/")
        self.length = length
        self.delay = delay
        self.lag = lag
        self.manifest = Manifest(self.root, "latest BIGINT")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if (query_id := running_query_id(spark)) is not None:
            record_owner(spark, self.root, query_id)
        before = self._latest_before(spark, batch_id)
        seen = Observation()
        known = self._latest_before(spark, batch_id - self.lag) if self.lag else before
        watermark = F.timestamp_micros(F.lit(known)) - F.expr(f"INTERVAL {self.delay}")
        closed = F.window("created_at", self.length)["end"] <= watermark
        (
            batch.observe(seen, F.max(F.unix_micros("created_at")).alias("latest"))
            .filter(closed)
            .write.mode("overwrite")
            .parquet(f"{self.root}/data/batch_id={batch_id}")
        )
        found = seen.get["latest"]
        latest = before if found is None else max(before, found)
        self.manifest.put(spark.range(0, 1, 1, 1).select(F.lit(latest).cast("bigint").alias("latest")), batch_id)

    def _latest_before(self, spark: SparkSession, batch_id: int) -> int:
        row = self.manifest.before(spark, batch_id)
        return row["latest"] if row else EARLIEST

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The late tickets of all complete batches; ``schema`` is that of the tickets."""
        visible = sorted(row["batch_id"] for row in self.manifest.read(spark).select("batch_id").collect())
        if not visible:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*[f"{self.root}/data/batch_id={one}" for one in visible])
