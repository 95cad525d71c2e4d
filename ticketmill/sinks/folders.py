"""Listing and removing result folders on any file system Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what is directly in a folder, sorted; none if there is no such folder."""
    files, folder = _file_system(spark, path)
    if not files.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(folder))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and all in it; nothing happens if it is gone already."""
    files, folder = _file_system(spark, path)
    files.delete(folder, True)
