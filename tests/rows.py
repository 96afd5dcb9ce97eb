"""Hand-made rows."""

from datetime import datetime

from trendmark.schemas import SNAPSHOT

RAW = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SNAPSHOT.fields)
RAW_SCHEMA = f"{RAW}, _arrived_at timestamp"

DEFAULTS = dict(
    video_id="v1",
    trending_date="17.14.11",
    title="t",
    channel_title="c",
    category_id=10,
    publish_time="2017-11-13T17:13:01.000Z",
    tags="a|b",
    views=100,
    likes=10,
    dislikes=1,
    comment_count=2,
    thumbnail_link="https://img.example/1.jpg",
    comments_disabled=False,
    ratings_disabled=False,
    video_error_or_removed=False,
    description="d",
    region="us",
    _arrived_at=datetime(2024, 1, 1),
)


def raw(spark, *changes):
    """Snapshot rows, each the default row with some changes."""
    rows = [tuple({**DEFAULTS, **change}.values()) for change in changes]
    return spark.createDataFrame(rows, RAW_SCHEMA)
