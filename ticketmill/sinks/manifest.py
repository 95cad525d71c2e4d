"""One small row per micro-batch that makes what the batch wrote visible, and carries its state.

A batch that is retried starts from the state of the batch before it and overwrites its own
folders, so its results are the same. What isn't in the manifest isn't read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession


class Manifest:
    def __init__(self, root: str, schema: str):
        self.path = f"{root}/_batches"
        self.schema = f"{schema}, batch_id BIGINT"

    def read(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return spark.createDataFrame([], self.schema)
            raise

    def before(self, spark: SparkSession, batch_id: int) -> Row | None:
        """The row of the newest batch before this one."""
        return self.read(spark).filter(f"batch_id < {batch_id}").orderBy("batch_id", ascending=False).first()

    def put(self, row: DataFrame, batch_id: int) -> None:
        """Make a batch visible: one row with the columns of the schema."""
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
