"""What a windowed query still holds in its state, read from its checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COUNT = "ticket_count"


def open_windows(spark: SparkSession, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """Windows that ``start_window_table`` hasn't written yet, with their counts so far: window, keys, ticket_count.

    The state is read as of the last complete micro-batch, partition by partition; nothing
    of the query runs. A query that is running may go on meanwhile.
    """
    state = spark.read.format("statestore").load(checkpoint)
    # The state's columns are those of the aggregation: its keys in their order, then its one count.
    return state.select(
        F.col("key").getField("window").alias("window"),
        *[F.col("key").getField(key).alias(key) for key in keys],
        F.col("value").getField("count").alias(COUNT),
    )
