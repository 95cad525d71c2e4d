"""Consecutive numbers over a whole table, without gathering it in one task.

Rows are dealt out by ranges of the wanted order and written once. A row's number is its
place in its range plus the rows of all ranges before; only one count per range is put
together. A range is split by all columns of the order, so no key gathers its rows.

Finding the ranges takes a pass over the rows of its own, and one more over partitions that have
far more rows than others. So the rows go through an even exchange first: they are computed
once, and what is read again are its files.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# monotonically_increasing_id() has the partition above these bits and the row in it below.
ROW_BITS = 33


def number_rows(rows: DataFrame, order: Sequence[Column], path: str) -> DataFrame:
    """``rows`` with ``position``, 0 for the first in the given order; they are written to ``path`` on the way.

    Rows that are equal in all of ``order`` are numbered in any order. An empty table stays empty.
    """
    spark = rows.sparkSession
    placed = rows.hint("rebalance").repartitionByRange(*order).sortWithinPartitions(*order)
    placed.withColumn("_place", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    schema = rows.withColumn("_place", F.lit(0).cast("bigint")).schema
    written = spark.read.schema(schema).parquet(path).withColumn("_range", F.shiftright("_place", ROW_BITS))
    # One number per range.
    sizes = sorted(written.groupBy("_range").count().collect())
    before = [0, *accumulate(size for _, size in sizes)]
    offsets = spark.createDataFrame(
        [(number, offset) for (number, _), offset in zip(sizes, before)], "_number BIGINT, _offset BIGINT"
    )
    in_range = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    numbered = written.join(F.broadcast(offsets), F.col("_range") == F.col("_number"))
    return numbered.select(*rows.columns, (F.col("_offset") + in_range).alias("position"))


def rank_rows(rows: DataFrame, order: Sequence[Column], path: str) -> DataFrame:
    """``rows`` with ``rank``, 1 for the first in the given order."""
    return number_rows(rows, order, path).select(*rows.columns, (F.col("position") + 1).alias("rank"))


def key_spans(numbered: DataFrame, key: str) -> DataFrame:
    """Of rows numbered by key first: per key ``_key`` the position ``_first`` of its first row, and its ``_rows``.

    Null is a key. Aggregated in each task first, so a key with very many rows sends one per task.
    """
    return numbered.groupBy(F.col(key).alias("_key")).agg(
        F.min("position").alias("_first"), F.count("*").alias("_rows")
    )


def number_within(rows: DataFrame, key: str, order: Sequence[Column], path: str) -> DataFrame:
    """``rows`` with ``position`` within the rows of their key, 0 for the first; null is a key."""
    numbered = number_rows(rows, [F.col(key), *order], path)
    joined = numbered.join(key_spans(numbered, key), F.col(key).eqNullSafe(F.col("_key")))
    return joined.select(*rows.columns, (F.col("position") - F.col("_first")).alias("position"))
