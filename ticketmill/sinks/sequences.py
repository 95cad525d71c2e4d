"""Tickets of a stream with a gap-free number per client, in order.

A micro-batch's tickets are numbered through, client by client; where a client's begin in it
and how many it has is one row per client, as is what it had before, from running totals kept
as merged runs of changes. The tickets are joined once, with what the two give together. So a
number costs no state in memory and no task per client: a client with a third of a batch is
spread over several tasks. Earlier batches come first; within a batch order is time, then ticket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.operators.numbering import key_spans, number_rows
from ticketmill.sinks.manifest import Manifest
from ticketmill.sinks.owner import record_owner, running_query_id
from ticketmill.sinks.runs import COUNT, PART, Run, Runs, RunStore

PARTS = 32
TOTALS = T.StructType(
    [T.StructField("client_id", T.StringType()), T.StructField(COUNT, T.LongType()), T.StructField(PART, T.IntegerType())]
)


class ClientSequencer:
    """A foreachBatch function that appends tickets with ``sequence``, 1 for a client's first.

    A retried batch gets the same numbers. Tickets without a client are numbered as one
    client's. An empty batch changes nothing.
    """

    def __init__(self, root: str) -> None:
        self.root = root.rstrip("/")
        self.store = RunStore(f"{self.root}/_totals", TOTALS, ["client_id"])
        self.manifest = Manifest(self.root, "runs STRING")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if (query_id := running_query_id(spark)) is not None:
            record_owner(spark, self.root, query_id)
        before = self._runs_before(spark, batch_id)
        order = [F.col("client_id"), F.col("created_at"), F.col("ticket_id")]
        numbered = number_rows(batch, order, f"{self.root}/_arrived/batch_id={batch_id}")
        spans = key_spans(numbered, "client_id")
        totals = self.store.totals(self.store.read(spark, before)).select(
            F.col("client_id").alias("_known"), F.col(COUNT).alias("_had")
        )
        shifts = spans.join(totals, F.col("_key").eqNullSafe(F.col("_known")), "left").select(
            "_key", (F.coalesce("_had", F.lit(0)) - F.col("_first") + 1).alias("_shift")
        )
        (
            numbered.join(shifts, F.col("client_id").eqNullSafe(F.col("_key")))
            .select(*batch.columns, (F.col("position") + F.col("_shift")).alias("sequence"))
            .write.mode("overwrite")
            .parquet(f"{self.root}/data/batch_id={batch_id}")
        )
        part = F.pmod(F.xxhash64("client_id"), F.lit(PARTS)).cast("int")
        counts = spans.select(F.col("_key").alias("client_id"), F.col("_rows").alias(COUNT)).withColumn(PART, part)
        sizes, _ = self.store.add(counts, 2 * batch_id, PARTS)
        runs = {
            one: before.get(one, []) + ([Run(2 * batch_id, sizes[one])] if one in sizes else [])
            for one in {*before, *sizes}
        }
        if before and sizes:
            runs = self.store.merge(spark, runs, 2 * batch_id + 1)
        text = ";".join(f"{one}:{','.join(f'{run.number}/{run.size}' for run in runs[one])}" for one in sorted(runs))
        self.manifest.put(spark.range(0, 1, 1, 1).select(F.lit(text).alias("runs")), batch_id)

    def _runs_before(self, spark: SparkSession, batch_id: int) -> Runs:
        row = self.manifest.before(spark, batch_id)
        parts = [one.partition(":") for one in row["runs"].split(";")] if row and row["runs"] else []
        return {
            int(part): [Run(*map(int, run.split("/"))) for run in runs.split(",")] for part, _, runs in parts
        }

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The numbered tickets of all complete batches; ``schema`` is that of the tickets."""
        visible = sorted(row["batch_id"] for row in self.manifest.read(spark).select("batch_id").collect())
        full = T.StructType([*schema, T.StructField("sequence", T.LongType())])
        if not visible:
            return spark.createDataFrame([], full)
        return spark.read.schema(full).parquet(*[f"{self.root}/data/batch_id={one}" for one in visible])
