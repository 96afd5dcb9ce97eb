"""Partition folders of written tables, by listing them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def located(spark: SparkSession, path: str):
    """A path and its file system, on whatever storage the cluster uses."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, target = located(spark, path)
    return filesystem.exists(target)


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders right below a path."""
    filesystem, target = located(spark, path)
    if not filesystem.exists(target):
        return []
    names = [status.getPath().getName() for status in filesystem.listStatus(target) if status.isDirectory()]
    return [name for name in names if "=" in name]


def partition_folders(spark: SparkSession, path: str, depth: int, within: Iterable[str] | None = None) -> list[str]:
    """Folders ``depth`` levels below ``path``, as relative paths.

    With ``within``, folders of another table, only those of them that this table has as well: only their parents
    are listed, whatever else the table holds.
    """
    if within is None:
        found = [""]
        for _ in range(depth):
            found = [f"{parent}/{name}".strip("/") for parent in found for name in _children(spark, f"{path}/{parent}")]
        return sorted(found)
    wanted: dict[str, set[str]] = {}
    for folder in within:
        parent, _, name = folder.rpartition("/")
        wanted.setdefault(parent, set()).add(name)
    return sorted(
        f"{parent}/{name}".strip("/") for parent, names in wanted.items() for name in names.intersection(_children(spark, f"{path}/{parent}"))
    )


def move_folders(spark: SparkSession, source: str, path: str, depth: int) -> None:
    """Move the partition folders of one table into another, in place of those of the same name.

    What was not moved yet still lies in ``source``, so a run that stops half-way goes on where it was.
    """
    for folder in partition_folders(spark, source, depth):
        filesystem, target = located(spark, f"{path}/{folder}")
        _, moved = located(spark, f"{source}/{folder}")
        filesystem.delete(target, True)
        filesystem.mkdirs(target.getParent())
        if not filesystem.rename(moved, target):
            raise OSError(f"{source}/{folder} could not be moved to {path}")
    spark.catalog.refreshByPath(path)


def read_folders(spark: SparkSession, path: str, folders: list[str], schema: T.StructType) -> DataFrame:
    """Rows of some partition folders of a table; no other folder is listed or read."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{folder}" for folder in folders])
