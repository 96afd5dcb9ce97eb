"""Raw API documents: one region per document, or an envelope of many regions.

Both layouts, for videos and for categories, are read through one schema and one pair of explodes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmark.config import UNKNOWN_REGION
from trendmark.functions import path_value, parse_timestamp, url_decoded
from trendmark.schemas import CORRUPT, document_schema

JSON_GLOB = "*.{json,JSON,txt,txt.gz}"


def read_documents(
    spark: SparkSession,
    path: str,
    item: T.StructType,
    multi_line: bool = True,
) -> DataFrame:
    """Documents below ``path`` with their file key and file time.

    Pretty-printed files (``multi_line``) hold one document each; otherwise each line is a document.
    """
    reader = spark.read.schema(document_schema(item)).option("columnNameOfCorruptRecord", CORRUPT)
    df = (
        reader.option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", JSON_GLOB)
        .json(path)
    )
    return with_file_columns(df, item)


def with_file_columns(df: DataFrame, item: T.StructType) -> DataFrame:
    """Document columns, ``_source_file`` (decoded path, where a plus sign is one) and ``_file_time``."""
    path = F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))
    return df.select(
        *document_schema(item).fieldNames(),
        url_decoded(path).alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_file_time"),
    )


def parse_documents(
    texts: DataFrame,
    item: T.StructType,
    text: str = "value",
    source_file: Column | None = None,
    file_time: Column | None = None,
) -> DataFrame:
    """The same columns as :func:`read_documents`, from documents held in a text column."""
    schema = document_schema(item)
    options = {"columnNameOfCorruptRecord": CORRUPT}
    return texts.select(
        F.from_json(F.col(text), schema, options).alias("_document"),
        (F.lit(None).cast("string") if source_file is None else url_decoded(source_file)).alias("_source_file"),
        (F.lit(None).cast("timestamp") if file_time is None else file_time).alias("_file_time"),
    ).select("_document.*", "_source_file", "_file_time")


def split_corrupt(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable documents, and the unreadable ones with their source for quarantine."""
    # Spark refuses to read the corrupt column alone; the second condition keeps a parsed column beside it.
    corrupt = F.col(CORRUPT).isNotNull() & ~F.col("fetched_at").eqNullSafe(F.lit("\0"))
    good = documents.filter(F.col(CORRUPT).isNull())
    bad = documents.filter(corrupt).select("_source_file", "_file_time", CORRUPT)
    return good, bad


def arrival_of(fetched_at: Column, metadata: Column, file_time: Column) -> Column:
    """When a payload arrived: its own fetch time if it states one, else the time of its file."""
    return F.coalesce(
        parse_timestamp(fetched_at),
        parse_timestamp(metadata["ingestion_timestamp"]),
        file_time,
    )


def explode_documents(documents: DataFrame, item: T.StructType, whole_object_fallback: bool = False) -> DataFrame:
    """One row per item: the item's fields, ``region``, ``_arrived_at``, ``_source_file``, ``_position``.

    A single-region document counts as an envelope of that one region. With the fallback, a document
    that has neither ``items`` nor ``regions`` is taken as one item itself.
    """
    metadata = F.col("_pipeline_metadata")
    own_region = F.coalesce(
        metadata["region"], path_value(F.col("_source_file"), "region", UNKNOWN_REGION), F.lit(UNKNOWN_REGION)
    )
    items = F.col("items")
    if whole_object_fallback:
        itself = F.array(F.struct(*item.fieldNames()))
        items = F.coalesce(items, F.when(F.col("regions").isNull(), itself))
    # A document without regions becomes an envelope of its own region.
    payloads = F.coalesce(
        F.col("regions"),
        F.create_map(own_region, F.struct(items.alias("items"), metadata.alias("_pipeline_metadata"))),
    )
    by_region = documents.select(
        F.explode(payloads).alias("region", "_payload"),
        F.col("fetched_at"),
        F.col("_file_time"),
        F.col("_source_file"),
    )
    return by_region.select(
        F.posexplode("_payload.items").alias("_position", "_item"),
        "region",
        arrival_of(F.col("fetched_at"), F.col("_payload._pipeline_metadata"), F.col("_file_time")).alias("_arrived_at"),
        "_source_file",
    ).select("_item.*", "region", "_arrived_at", "_source_file", "_position")
