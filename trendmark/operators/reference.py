"""Category reference data: flatten, keep the last of each id, replace by region."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendmark.functions import clean_region, flatten_struct
from trendmark.schemas import CATEGORY_ITEM
from trendmark.sources.documents import explode_documents


def category_items(documents: DataFrame, fallback: bool = True) -> DataFrame:
    """One row per category item with dotted columns, from either document layout."""
    return flatten_struct(explode_documents(documents, CATEGORY_ITEM, fallback))


#: Whether a later item of the document and region has the same id.
REPEATED = "_repeated"


def numbered_categories(items: DataFrame) -> DataFrame:
    """``items`` with ``_repeated``. Items without an id count as one id, as all their missing ids are equal."""
    newest = Window.partitionBy("_source_file", "region", "id").orderBy(F.col("_position").desc())
    return items.withColumn(REPEATED, F.row_number().over(newest) > 1)


def keep_last_category(items: DataFrame) -> DataFrame:
    """The last item of each id within its document and region."""
    newest = Window.partitionBy("_source_file", "region", "id").orderBy(F.col("_position").desc())
    return items.withColumn("_nth", F.row_number().over(newest)).filter(F.col("_nth") == 1).drop("_nth")


def newest_document(items: DataFrame) -> DataFrame:
    """The rows of each region's newest document, which replaces all earlier ones of the region.

    One pass: tasks drop rows of older documents before the shuffle, so a region sends those of its newest alone.
    """
    newest = Window.partitionBy("region").orderBy(F.col("_arrived_at").desc(), F.col("_source_file").desc())
    return items.withColumn("_age", F.rank().over(newest)).filter(F.col("_age") == 1).drop("_age")


def refine_reference(documents: DataFrame) -> DataFrame:
    """Reference rows ready to be written: each region's newest document, its last item of each id.

    Items without an id name no category and are left out; ``operators.validation`` reports them.
    """
    items = category_items(documents).filter(F.trim("id") != "").withColumn("region", clean_region(F.col("region")))
    return keep_last_category(newest_document(items)).drop("_position")
