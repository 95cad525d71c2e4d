"""Running totals as a log of changes per key, merged run by run.

Every micro-batch adds one run: its own counts, sorted by the part their key belongs to. A
key's total is the sum over the runs. So that they stay few, each batch merges the newest runs
of one part, the one with the most: as many of them as are no larger than ``RATIO`` times what
is newer. A large old run is thus written again only when the changes to its part have grown to
its size, and a batch writes its own changes and at most one part, however many keys it
touches. A part has about as many runs as there are parts, and a few larger ones.

Runs are numbered and never written again once a reader can see them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.sinks.folders import delete_folder, list_folders

COUNT = "ticket_count"
PART = "bucket"
RATIO = 2


@dataclass(frozen=True)
class Run:
    number: int
    size: int


# The runs of each part, oldest first.
Runs = dict[int, list[Run]]


class RunStore:
    """Totals per key below one folder; ``keys`` tell rows apart within a part."""

    def __init__(self, root: str, schema: T.StructType, keys: Iterable[str]):
        self.root = root
        self.schema = schema
        self.keys = tuple(keys)

    def _path(self, number: int) -> str:
        return f"{self.root}/run={number}"

    def write(self, rows: DataFrame, number: int, **sums: Column) -> dict[str, int]:
        """Write one run; the given sums over its rows, observed by the write itself."""
        seen = Observation()
        sized = [F.sum(one).alias(name) for name, one in sums.items()]
        observed = rows.select(self.schema.names).sortWithinPartitions(PART).observe(seen, *sized)
        observed.write.mode("overwrite").parquet(self._path(number))
        return {name: value or 0 for name, value in seen.get.items()}

    def add(self, changes: DataFrame, number: int, parts: int, **sums: Column) -> tuple[dict[int, int], dict[str, int]]:
        """Write a batch's counts as one run: its rows in each of the parts that has any, and further sums."""
        sizes = {f"part_{part}": F.when(F.col(PART) == part, 1) for part in range(parts)}
        found = self.write(changes, number, **sizes, **sums)
        of_parts = {part: found.pop(name) for part, name in enumerate(sizes)}
        return {part: size for part, size in of_parts.items() if size}, found

    def read(self, spark: SparkSession, runs: Runs, parts: Iterable[int] | None = None) -> DataFrame:
        """The rows of the wanted parts (None: all) in all their runs, from one scan."""
        wanted: dict[int, list[int]] = {}
        for part in sorted(runs if parts is None else parts):
            for run in runs.get(part, []):
                wanted.setdefault(run.number, []).append(part)
        if not wanted:
            return spark.createDataFrame([], self.schema)  # nothing has been added so far
        with_run = T.StructType([*self.schema, T.StructField("run", T.LongType())])
        scan = (
            spark.read.schema(with_run)
            .option("basePath", self.root)
            .parquet(*[self._path(number) for number in sorted(wanted)])
        )
        inside = [(F.col("run") == number) & F.col(PART).isin(of_run) for number, of_run in sorted(wanted.items())]
        return scan.filter(reduce(Column.__or__, inside)).drop("run")

    def totals(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(PART, *self.keys).agg(F.sum(COUNT).alias(COUNT))

    def merge(self, spark: SparkSession, runs: Runs, number: int) -> Runs:
        """Merge the newest runs of the part that has the most into one run, if they are due."""
        part = max(runs, key=lambda one: (len(runs[one]), -one))
        newest = due(runs[part])
        if len(newest) < 2:
            return runs
        written = self.write(self.totals(self.read(spark, {part: newest})), number, size=F.lit(1))
        return {**runs, part: [*runs[part][: -len(newest)], Run(number, written["size"])]}

    def keep_only(self, spark: SparkSession, kept: set[int], up_to: int) -> None:
        """Remove runs numbered up to ``up_to`` but those in ``kept``."""
        for folder in list_folders(spark, self.root):
            number = int(folder.removeprefix("run="))
            if number <= up_to and number not in kept:
                delete_folder(spark, f"{self.root}/{folder}")


def due(runs: list[Run]) -> list[Run]:
    """The newest runs that are to be merged, oldest first: each no larger than ``RATIO`` times what is newer."""
    taken, size = 1, runs[-1].size
    for run in reversed(runs[:-1]):
        if run.size > RATIO * size:
            break
        taken, size = taken + 1, size + run.size
    return runs[-taken:]
