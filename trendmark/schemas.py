"""Schemas of the raw inputs and of the canonical snapshot."""

from __future__ import annotations

from pyspark.sql import types as T

from trendmark.config import CATEGORY, CHANNEL, TRENDING


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


_STRING = T.StringType()
_LONG = T.LongType()
_BOOL = T.BooleanType()

# The canonical snapshot columns, in output order.
SNAPSHOT = _struct(
    video_id=_STRING,
    trending_date=_STRING,
    title=_STRING,
    channel_title=_STRING,
    category_id=_LONG,
    publish_time=_STRING,
    tags=_STRING,
    views=_LONG,
    likes=_LONG,
    dislikes=_LONG,
    comment_count=_LONG,
    thumbnail_link=_STRING,
    comments_disabled=_BOOL,
    ratings_disabled=_BOOL,
    video_error_or_removed=_BOOL,
    description=_STRING,
    region=_STRING,
)
SNAPSHOT_COLUMNS = SNAPSHOT.fieldNames()
COUNTERS = ["views", "likes", "dislikes", "comment_count"]

# CSV files carry every column but the region, which is the partition folder. All of it is read as
# text, so that one malformed number becomes NULL in its own cell and nowhere else.
CSV_FILE = T.StructType([T.StructField(name, _STRING) for name in SNAPSHOT_COLUMNS if name != "region"])

VIDEO_ITEM = _struct(
    id=_STRING,
    snippet=_struct(
        title=_STRING,
        channelTitle=_STRING,
        categoryId=_STRING,
        publishedAt=_STRING,
        tags=T.ArrayType(_STRING),
        description=_STRING,
        thumbnails=_struct(default=_struct(url=_STRING)),
    ),
    statistics=_struct(viewCount=_STRING, likeCount=_STRING, dislikeCount=_STRING, commentCount=_STRING),
)

CATEGORY_ITEM = _struct(id=_STRING, snippet=_struct(title=_STRING))

FETCH_METADATA = _struct(
    ingestion_id=_STRING,
    region=_STRING,
    ingestion_timestamp=_STRING,
    video_count=_LONG,
    source=_STRING,
)

CORRUPT = "_corrupt_record"


def document_schema(item: T.StructType) -> T.StructType:
    """One schema for both raw layouts: a single-region document and an envelope of many regions.

    A field a document lacks reads as NULL, and text that is no document lands in the corrupt column.
    The item's own fields are repeated at the top for documents that are a bare item.
    """
    region_payload = _struct(items=T.ArrayType(item), _pipeline_metadata=FETCH_METADATA)
    fields = [
        *item.fields,
        T.StructField("items", T.ArrayType(item)),
        T.StructField("_pipeline_metadata", FETCH_METADATA),
        T.StructField("ingestion_id", _STRING),
        T.StructField("fetched_at", _STRING),
        T.StructField("regions", T.MapType(_STRING, region_payload)),
        T.StructField(CORRUPT, _STRING),
    ]
    return T.StructType(fields)


CHECK_ROW = T.StructType(
    [
        T.StructField("check", _STRING),
        T.StructField("table", _STRING),
        T.StructField("column", _STRING),
        T.StructField("value", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("missing_columns", T.ArrayType(_STRING)),
        T.StructField("negative_count", _LONG),
        T.StructField("extreme_count", _LONG),
        T.StructField("latest_record", _STRING),
        T.StructField("cutoff", _STRING),
        T.StructField("passed", _BOOL),
        T.StructField("message", _STRING),
    ]
)

SILVER_STATISTICS = T.StructType(
    [
        *[field for field in SNAPSHOT.fields if field.name != "region"],
        T.StructField("_arrived_at", T.TimestampType()),
        T.StructField("like_ratio", T.DoubleType()),
        T.StructField("engagement_rate", T.DoubleType()),
        T.StructField("_processed_at", T.TimestampType()),
        T.StructField("_job_name", _STRING),
        T.StructField("region", _STRING),
        T.StructField("trending_date_parsed", T.DateType()),
    ]
)
#: The same table split by day. Rows without a day lie in buckets by video, so that one of them touches its bucket only.
BUCKET = "_bucket"
SILVER_BY_DAY = T.StructType([*SILVER_STATISTICS.fields, T.StructField(BUCKET, T.IntegerType())])

_DOUBLE = T.DoubleType()
_DATE = T.DateType()
_TIME = T.TimestampType()

# The columns of the Gold tables.
GOLD = {
    TRENDING: _struct(
        region=_STRING,
        trending_date_parsed=_DATE,
        total_videos=_LONG,
        total_views=_LONG,
        total_likes=_LONG,
        total_dislikes=_LONG,
        total_comments=_LONG,
        avg_views_per_video=_DOUBLE,
        avg_like_ratio=_DOUBLE,
        avg_engagement_rate=_DOUBLE,
        max_views=_LONG,
        unique_channels=_LONG,
        unique_categories=_LONG,
        _aggregated_at=_TIME,
    ),
    CHANNEL: _struct(
        channel_title=_STRING,
        region=_STRING,
        total_videos=_LONG,
        total_views=_LONG,
        total_likes=_LONG,
        total_comments=_LONG,
        avg_views_per_video=_DOUBLE,
        avg_engagement_rate=_DOUBLE,
        peak_views=_LONG,
        times_trending=_LONG,
        first_trending=_DATE,
        last_trending=_DATE,
        categories=T.ArrayType(_STRING),
        rank_in_region=T.IntegerType(),
        _aggregated_at=_TIME,
    ),
    CATEGORY: _struct(
        category_name=_STRING,
        category_id=_LONG,
        region=_STRING,
        trending_date_parsed=_DATE,
        video_count=_LONG,
        total_views=_LONG,
        total_likes=_LONG,
        total_comments=_LONG,
        avg_engagement_rate=_DOUBLE,
        unique_channels=_LONG,
        view_share_pct=_DOUBLE,
        _aggregated_at=_TIME,
    ),
}
