"""Results set aside in full before a table is touched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from trendmark.sinks.tables import write_partitioned
from trendmark.sources.folders import located, partition_folders, path_exists

# Written after a stage is complete; readers skip names with a leading underscore.
MARKER = "_FINISHED"


class Stage:
    """A folder that counts only once it is complete, so that a run which stops half-way can go on from it."""

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str]):
        self.spark, self.path, self.partition_by = spark, path, tuple(partition_by)

    @property
    def finished(self) -> bool:
        return path_exists(self.spark, f"{self.path}/{MARKER}")

    def write(self, df: DataFrame, rebalance: bool = True) -> None:
        write_partitioned(df, self.path, self.partition_by, rebalance, whole_table=True)
        self.mark()

    def mark(self) -> None:
        filesystem, marker = located(self.spark, f"{self.path}/{MARKER}")
        filesystem.create(marker, True).close()

    def read(self, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path)

    def folders(self) -> list[str]:
        return partition_folders(self.spark, self.path, len(self.partition_by))

    def discard(self) -> None:
        filesystem, folder = located(self.spark, self.path)
        filesystem.delete(folder, True)
