"""Which streaming query a target belongs to, and the refusal of any other.

A query's identity lives in its checkpoint. A target that was filled under one identity
must not be continued under another: batch numbers would start again, and the sink would
take new batches for old ones.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class LostCheckpointError(RuntimeError):
    """The target holds results of a query whose checkpoint is gone or was replaced."""


def _text(spark: SparkSession, path: str) -> DataFrame | None:
    """The text under ``path``; None if there is no such path."""
    try:
        return spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _first_line(spark: SparkSession, path: str) -> str | None:
    text = _text(spark, path)
    row = text.first() if text is not None else None
    return row[0] if row else None


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The query's identity in a checkpoint; None if it has none yet."""
    line = _first_line(spark, f"{checkpoint}/metadata")
    return json.loads(line)["id"] if line else None


def owner_of(spark: SparkSession, target: str) -> str | None:
    return _first_line(spark, f"{target}/_owner")


def refuse_other_owner(spark: SparkSession, target: str, query_id: str | None) -> None:
    """Raise if ``target`` holds results of a query other than ``query_id`` (None: a new one)."""
    owner = owner_of(spark, target)
    if owner == query_id:
        if owner is None and _text(spark, f"{target}/_spark_metadata") is not None:
            raise LostCheckpointError(f"{target} has a commit log, but the checkpoint is new or gone")
    elif owner is not None:
        raise LostCheckpointError(
            f"{target} belongs to query {owner}, not to {query_id or 'a new one'}: its checkpoint is gone or "
            "was replaced; restore it, or start with a new target"
        )


def record_owner(spark: SparkSession, target: str, query_id: str) -> None:
    """Note the owner of a target. Doing it again changes nothing."""
    refuse_other_owner(spark, target, query_id)
    if owner_of(spark, target) is None:
        spark.range(0, 1, 1, 1).select(F.lit(query_id)).write.mode("overwrite").text(f"{target}/_owner")


def running_query_id(spark: SparkSession) -> str | None:
    """The identity of the streaming query whose micro-batch is running; None outside of one."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")
