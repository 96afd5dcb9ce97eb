"""Row-wise cleansing: one narrow stage, no shuffle."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmark.functions import clean_region, parse_trending_date, percent_of
from trendmark.schemas import COUNTERS


def drop_keyless(df: DataFrame, key: str = "video_id") -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def fill_counters(df: DataFrame) -> DataFrame:
    return df.fillna(0, subset=COUNTERS)


def like_ratio() -> Column:
    return percent_of(F.col("likes").cast("double"), F.col("views"))


def engagement_rate() -> Column:
    reactions = [F.col(name).cast("double") for name in ("likes", "dislikes", "comment_count")]
    return percent_of(reactions[0] + reactions[1] + reactions[2], F.col("views"))


def settle(df: DataFrame) -> DataFrame:
    """Drop keyless rows, settle region, date and counters."""
    settled = drop_keyless(df).withColumns(
        {
            "region": clean_region(F.col("region")),
            "trending_date_parsed": parse_trending_date(F.col("trending_date")),
        }
    )
    return fill_counters(settled)


def with_ratios(settled: DataFrame) -> DataFrame:
    return settled.withColumns({"like_ratio": like_ratio(), "engagement_rate": engagement_rate()})


def cleanse(df: DataFrame) -> DataFrame:
    """Drop keyless rows, settle region, date and counters, and derive the two ratios."""
    return with_ratios(settle(df))


def moment(now: datetime | None) -> Column:
    return F.current_timestamp() if now is None else F.lit(now).cast("timestamp")


def with_audit(
    df: DataFrame,
    stamp: str,
    now: datetime | None = None,
    as_text: bool = False,
    **constants: str,
) -> DataFrame:
    """Add when (``stamp``) and constant labels saying by what the rows were made."""
    when = moment(now)
    if as_text:
        when = F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return df.withColumns({stamp: when, **{name: F.lit(value) for name, value in constants.items()}})
