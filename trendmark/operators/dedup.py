"""One row for each key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendmark.operators.normalize import ARRIVED_AT
from trendmark.schemas import COUNTERS, SNAPSHOT_COLUMNS

SNAPSHOT_KEY = ("video_id", "region", "trending_date_parsed")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    Spark limits every task's share of a key to one row before the shuffle, so a key that holds a large
    part of all rows sends one row per task and no more.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row_num", F.row_number().over(window)).filter(F.col("_row_num") == 1).drop("_row_num")


def snapshot_order() -> list[Column]:
    """Latest arrival first, then the higher counters; the other columns settle what is still equal."""
    settled = [*COUNTERS, *[name for name in SNAPSHOT_COLUMNS if name not in (*COUNTERS, *SNAPSHOT_KEY)]]
    return [F.col(name).desc_nulls_last() for name in (ARRIVED_AT, *settled)]


def keep_latest_snapshot(df: DataFrame) -> DataFrame:
    """The latest row of each video, region and day."""
    return keep_first(df, SNAPSHOT_KEY, snapshot_order())
