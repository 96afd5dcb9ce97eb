"""The category lookup and its join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmark.config import UNKNOWN
from trendmark.functions import field_or, has_field
from trendmark.operators.broadcasting import broadcast_if_small


def category_lookup(reference: DataFrame) -> DataFrame | None:
    """One name for each category id, or None if the reference has no id or no title column.

    Where regions disagree on a name, the region that comes first in the alphabet is followed.
    """
    if not (has_field(reference, "id") and has_field(reference, "snippet.title")):
        return None
    named = reference.select(
        field_or(reference, "id", "bigint").alias("category_id"),
        field_or(reference, "snippet.title", "string").alias("category_name"),
        field_or(reference, "region", "string").alias("_region"),
    )
    preference = F.struct(F.col("category_name").isNull(), F.col("_region"), F.col("category_name"))
    return named.groupBy("category_id").agg(F.min_by("category_name", preference).alias("category_name"))


def attach_category_names(statistics: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Statistics with ``category_name``, ``Unknown`` where there is none; no row is added or lost."""
    if lookup is None:
        return statistics.withColumn("category_name", F.lit(UNKNOWN))
    keyed = statistics.withColumn("category_id", F.col("category_id").try_cast("bigint"))
    joined = keyed.join(broadcast_if_small(lookup), "category_id", "left")
    return joined.fillna(UNKNOWN, subset=["category_name"])
