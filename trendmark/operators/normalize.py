"""Both raw shapes to the canonical snapshot columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmark.functions import field_or
from trendmark.functions.columns import SHORT_DATE_FORMAT
from trendmark.schemas import SNAPSHOT

ARRIVED_AT = "_arrived_at"

# Where each canonical column sits in an API item.
API_FIELDS = {
    "video_id": "id",
    "title": "snippet.title",
    "channel_title": "snippet.channelTitle",
    "category_id": "snippet.categoryId",
    "publish_time": "snippet.publishedAt",
    "tags": "snippet.tags",
    "views": "statistics.viewCount",
    "likes": "statistics.likeCount",
    "dislikes": "statistics.dislikeCount",
    "comment_count": "statistics.commentCount",
    "thumbnail_link": "snippet.thumbnails.default.url",
    "description": "snippet.description",
    "region": "region",
}


def _arrival(df: DataFrame) -> Column:
    return field_or(df, ARRIVED_AT, "timestamp").alias(ARRIVED_AT)


def normalize_csv(df: DataFrame) -> DataFrame:
    """Historical rows: the canonical columns by name; a value that is not of its type becomes NULL."""
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in SNAPSHOT.fields]
    return df.select(*typed, _arrival(df))


def normalize_json(df: DataFrame) -> DataFrame:
    """API items, nested or flattened in any spelling, to the canonical columns.

    The snapshot date is the day of arrival. The API reports no flags, so they are false; a missing
    dislike counter is 0 and other missing fields are NULL.
    """
    fixed: dict[str, Column] = {
        "trending_date": F.date_format(field_or(df, ARRIVED_AT, "timestamp"), SHORT_DATE_FORMAT),
        "comments_disabled": F.lit(False),
        "ratings_disabled": F.lit(False),
        "video_error_or_removed": F.lit(False),
    }
    columns = []
    for field in SNAPSHOT.fields:
        if field.name in fixed:
            column = fixed[field.name]
        else:
            default = 0 if field.name == "dislikes" else None
            column = field_or(df, API_FIELDS[field.name], field.dataType.simpleString(), default)
        columns.append(column.alias(field.name))
    return df.select(*columns, _arrival(df))


def union_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all normalised sources; a source without rows simply adds none."""
    for other in others:
        first = first.unionByName(other)
    return first
