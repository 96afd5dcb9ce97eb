"""Partitioned Parquet tables, replaced partition by partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmark.sources.folders import move_folders
from trendmark.sources.tables import TableStore


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("region",),
    rebalance: bool = True,
    whole_table: bool = False,
    staged: str | None = None,
) -> None:
    """Replace the partitions that ``df`` holds rows for, and leave all others as they are.

    With ``whole_table`` the others are removed. Where ``df`` is what lies in ``staged``, a folder split the same way on the same
    storage, its files are moved and not written again.

    Rebalancing gathers each partition's rows into files of the advisory size. Adaptive execution
    cuts a partition that holds much of the data into many tasks, so one busy region is no bottleneck.
    """
    if staged is not None:
        return move_folders(df.sparkSession, staged, path, len(partition_by))
    if rebalance:
        df = df.hint("rebalance", *[F.col(name) for name in partition_by])
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole_table else "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partition_by)
        .parquet(path)
    )


#: Partitions named in one statement.
_AT_ONCE = 500


def register(
    store: TableStore,
    name: str,
    partition_by: Sequence[str] = ("region",),
    schema: T.StructType | None = None,
    partitions: Sequence[Row] | None = None,
) -> None:
    """List the table in its database: create it, or add the columns and partitions it has gained.

    ``schema`` is that of the rows just written, ``partitions`` the partition values they have. Without them
    the table's files and folders are looked through.
    """
    if store.database is None:
        return
    spark = store.spark
    table = f"`{store.database}`.`{name}`"
    fields = (schema or store.read(name, merge_schema=True).schema).fields
    if spark.catalog.tableExists(table):
        known = set(spark.table(table).columns)
        gained = [field for field in fields if field.name not in known]
        if gained:
            columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in gained)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    else:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{store.database}`")
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in fields)
        parts = ", ".join(f"`{part}`" for part in partition_by)
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({parts}) LOCATION '{store.path(name)}'"
        )
        partitions = None  # what was written before the table was listed is listed too
    if partitions is None:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    for first in range(0, len(partitions or ()), _AT_ONCE):
        named = " ".join(f"PARTITION ({_values(row, partition_by)})" for row in partitions[first : first + _AT_ONCE])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {named}")
    spark.catalog.refreshTable(table)


def _values(row: Row, partition_by: Sequence[str]) -> str:
    quoted = {part: "null" if row[part] is None else "'" + str(row[part]).replace("\\", "\\\\").replace("'", "\\'") + "'" for part in partition_by}
    return ", ".join(f"`{part}` = {value}" for part, value in quoted.items())


def publish(
    df: DataFrame,
    store: TableStore,
    name: str,
    partition_by: Sequence[str] = ("region",),
    rebalance: bool = True,
) -> None:
    """Write a table of a layer and list it."""
    write_partitioned(df, store.path(name), partition_by, rebalance)
    register(store, name, partition_by, df.schema)
