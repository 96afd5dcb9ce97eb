"""Historical snapshots in CSV files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmark.config import UNKNOWN_REGION
from trendmark.functions import path_value
from trendmark.operators.broadcasting import broadcast_if_small
from trendmark.schemas import CSV_FILE
from trendmark.sources.csv_headers import CSV_GLOB, header_lines, header_names, place_of


def _csv_options(reader: DataFrameReader, multi_line: bool) -> DataFrameReader:
    return (
        reader.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("pathGlobFilter", CSV_GLOB)
    )


def in_regions(df: DataFrame, regions: Iterable[str] | None) -> DataFrame:
    """Keep some regions only. On a partition column, or one taken from the path, no other file is read."""
    if regions is None:
        return df
    wanted = sorted({region.strip().lower() for region in regions})
    return df.filter(F.lower(F.col("region")).isin(wanted))


def read_csv_snapshots(
    spark: SparkSession,
    path: str,
    regions: Iterable[str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """All CSV snapshots below ``path``, as text columns, with ``region`` and ``_arrived_at``.

    Columns are found by their names in each file's own header, in any order and case; a column that a file lacks is
    NULL in its rows, and other columns are ignored. The headers are read first, one short task for each file.

    The region is that of the file's ``region=`` folder, at any depth, as other layouts may lie beside it.
    ``multi_line`` allows line breaks inside quoted text; each file is then read by one task. Switch it
    off for files known to hold none, and Spark splits them.
    """
    named = header_lines(spark, path).select(F.col("source").alias("_source"), header_names(F.col("header")).alias("names"))
    width = named.agg(F.max(F.size("names"))).first()[0] or 1
    cells = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    # Cells by position, without the first line of each file.
    rows = _csv_options(spark.read, multi_line).schema(cells).option("recursiveFileLookup", True).csv(path)
    places = named.select("_source", *[place_of(F.col("names"), name).alias(f"_{name}") for name in CSV_FILE.fieldNames()])
    source = F.col("_metadata.file_path").alias("_file")
    placed = rows.select(F.array(*cells.fieldNames()).alias("cells"), source, *snapshot_file_columns())
    by_name = placed.join(broadcast_if_small(places), F.col("_file") == F.col("_source"))
    columns = [F.get("cells", F.col(f"_{name}")).alias(name) for name in CSV_FILE.fieldNames()]
    return in_regions(by_name.select(*columns, "region", "_arrived_at"), regions)


def snapshot_file_columns() -> list[Column]:
    """Region and arrival of a snapshot file."""
    return [
        path_value(F.col("_metadata.file_path"), "region", UNKNOWN_REGION).alias("region"),
        F.col("_metadata.file_modification_time").alias("_arrived_at"),
    ]


def read_csv_inferred(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """CSV files of any layout, at any depth below ``path``, with column types taken from the data."""
    reader = _csv_options(spark.read, multi_line)
    return reader.option("recursiveFileLookup", True).option("inferSchema", True).csv(path)
