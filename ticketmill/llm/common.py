"""Helpers shared by the operators: tables, Arrow maps and written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ticketmill.session import scratch_dir

# Bounds of one Arrow batch between the JVM and Python: texts may be very long.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20
PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, so that no other column can clash with its results."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def arrow_map(
    frame: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` with batches bounded in rows and bytes."""
    prepare_workers(frame.sparkSession)
    return frame.mapInArrow(function, schema)


def prepare_workers(spark: SparkSession) -> None:
    """Bounds Arrow batches (session settings, as Spark has no other place for them) and lets workers import this package."""
    workers = spark.sparkContext.environment
    if PACKAGE_ROOT not in workers.get("PYTHONPATH", ""):
        # For where it isn't installed or shipped with --py-files.
        workers["PYTHONPATH"] = ":".join(filter(None, [workers.get("PYTHONPATH"), PACKAGE_ROOT]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written to the shared scratch folder and read back: its lineage ends there."""
    spark = frame.sparkSession
    path = scratch_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_crc(column: Column) -> Column:
    """CRC-32 of a value's text, unsigned; null for null."""
    return F.crc32(column.cast("string").cast("binary"))


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    """Texts; null counts as empty."""
    return [value or "" for value in column.to_pylist()]


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (multiply and shift, twice)."""
    values = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values ^= values >> np.uint64(shift)
        values *= np.uint64(factor)
    values ^= values >> np.uint64(31)
    return values


def rolling_hashes(values: np.ndarray, length: int, base: int) -> np.ndarray:
    """Polynomial hashes mod 2**64 of every run of ``length`` consecutive values.

    Runs of doubled length are put together from two halves, so the cost is a handful
    of array operations whatever the length.
    """
    total = len(values) - length + 1
    if total <= 0:
        return np.zeros(0, dtype=np.uint64)
    mask = (1 << 64) - 1
    power, power_length = values.astype(np.uint64), 1
    result, done, rest = None, 0, length
    while rest:
        if rest & 1:
            if result is None:
                result, done = power, power_length
            else:
                # the part found so far, then a run of power_length values behind it
                behind = power[done:]
                size = min(len(result), len(behind))
                factor = np.uint64(pow(base, power_length, mask + 1))
                result, done = result[:size] * factor + behind[:size], done + power_length
        rest >>= 1
        if rest:
            factor = np.uint64(pow(base, power_length, mask + 1))
            size = len(power) - power_length
            power, power_length = power[:size] * factor + power[power_length:], power_length * 2
    return result[:total]
