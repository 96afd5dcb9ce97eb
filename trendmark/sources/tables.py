"""Tables of the refined layers, by path, optionally registered in a catalog database."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableStore:
    """A layer: a root folder with one folder per table, and the database that lists them, if any."""

    spark: SparkSession
    root: str
    database: str | None = None

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def exists(self, name: str) -> bool:
        """Whether the table has been written; an unreachable store still raises."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        filesystem = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return filesystem.exists(path)

    def read(self, name: str, merge_schema: bool = False, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read.option("mergeSchema", merge_schema)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(self.path(name))

    def read_if_present(self, name: str, merge_schema: bool = False) -> DataFrame | None:
        """The table, or None when it is absent. No other failure is hidden."""
        return self.read(name, merge_schema) if self.exists(name) else None


def sample(df: DataFrame, rows: int | None) -> DataFrame:
    """At most ``rows`` rows, whichever come first; all of them for None."""
    return df if rows is None else df.limit(rows)


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than the session has cores, dealt out to all of them.

    A file without inner splits is read by one task, and what follows the scan would stay in it. Large
    inputs have splits enough and are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def with_columns_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns it lacks added as NULL, and columns of its own kept at the end."""
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in df.columns]
    widened = df.select("*", *added)
    extra = [name for name in df.columns if name not in schema.fieldNames()]
    return widened.select(*schema.fieldNames(), *extra)
