"""Session settings, scratch space and per-query state sizing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_CONF = {
    # hour() and timestamp text follow the session zone; the data is UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keeps large keyed state (per client) off the JVM heap and uploads deltas.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "ticketmill", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings above; ``master`` is left to spark-submit when None."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Make a session that was built elsewhere read and print times in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the session's shared folder.

    Results are read from it after the call, so it is left to that folder's clean-up.
    """
    return f"{shared_folder(spark)}/ticketmill/{label}-{uuid.uuid4().hex}"


def shared_folder(spark: SparkSession) -> str:
    """The folder all nodes share: ``spark.checkpoint.dir``, else one below the warehouse.

    Where executors run on other nodes, a warehouse on the driver's own disk is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not is_local(spark.sparkContext.master) and warehouse.startswith(("file:", "/")):
            raise ValueError(f"{warehouse} isn't shared by the nodes: set spark.checkpoint.dir")
        folder = f"{warehouse}/_scratch"
    return folder.rstrip("/")


def is_local(master: str) -> bool:
    """Whether executors share the driver's disk because they are threads of it."""
    return master == "local" or master.startswith("local[")


@contextmanager
def state_partitions(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Fix the number of state partitions of the streaming queries started inside.

    A query copies the session settings when it starts and keeps its partition
    count for the life of its checkpoint. The default is the session's number of
    shuffle partitions.
    """
    if partitions is None:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(key, before)
