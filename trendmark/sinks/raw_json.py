"""Raw documents as fetched, laid out by fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmark.functions import partition_stamps
from trendmark.operators.broadcasting import is_small


def write_raw_documents(documents: DataFrame, text: str, moment: Column, path: str, by_hour: bool = True) -> None:
    """Write one document a line below ``date=/hour=`` (statistics) or ``date=`` (categories).

    Each fetch has its own folder below those, named after its second and its content. Landing a fetch again replaces it
    and nothing else; other documents of the same second have other content and so another folder. Nothing landed before
    is read or written again. The text is written as it came, in gzip files: fields no schema names are kept.
    """
    stamps = partition_stamps(moment)
    folders = ["date", "hour", "ingestion_id"] if by_hour else ["date", "ingestion_id"]
    rows = documents.select(F.col(text).alias("value"), *[stamps[name].alias(name) for name in folders])
    # Measured by the seconds alone, so that no text is made for it.
    few = is_small(rows.select("ingestion_id").distinct())
    if few:
        # Dealt out first: the texts are made and shuffled once, and read from there for their names and to be written.
        rows = rows.hint("rebalance", *[F.col(name) for name in folders])
    # The same for the same documents in any order; a row for each second.
    content = F.sha1(F.concat_ws(" ", F.count("*"), F.sum(F.xxhash64("value").cast("decimal(20,0)"))))
    fetches = rows.groupBy(F.col("ingestion_id").alias("_second")).agg(F.substring(content, 1, 16).alias("_content"))
    if few:
        fetches = F.broadcast(fetches)
    same = F.col("ingestion_id").eqNullSafe(F.col("_second"))
    named = rows.join(fetches, same).withColumn("ingestion_id", F.concat_ws("-", "ingestion_id", "_content")).select("value", *folders)
    if not few:
        named = named.hint("rebalance", *[F.col(name) for name in folders])
    (
        named.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy(*folders)
        .text(path)
    )
