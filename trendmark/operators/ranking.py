"""Row numbers in groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendmark.operators.broadcasting import broadcast_if_small
from trendmark.session import durable

# monotonically_increasing_id keeps the partition number above this many bits of row position.
_POSITION_BITS = 33


def number_rows(df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``row_number`` of each group under ``order``, without gathering a group in one task.

    The rows are range-partitioned by group and order, so that a large group spreads over many sorted
    slices. A row's number is its place in its slice plus the rows its group has in earlier slices.
    ``order`` should leave no ties: a slice is never cut between equal rows.
    """
    placed = durable(
        df.repartitionByRange(*[F.col(group) for group in groups], *order)
        .sortWithinPartitions(*[F.col(group) for group in groups], *order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    sliced = placed.withColumn("_slice", F.shiftright("_place", _POSITION_BITS))

    # At most one row for each slice and group in it.
    starts = sliced.groupBy(*groups, "_slice").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = starts.select(
        *[F.col(group).alias(f"_{group}") for group in groups],
        F.col("_slice").alias("_in_slice"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )

    same = F.col("_slice") == F.col("_in_slice")
    for group in groups:
        same = same & F.col(group).eqNullSafe(F.col(f"_{group}"))
    numbered = sliced.join(broadcast_if_small(offsets), same, "left")
    return numbered.select(*df.columns, (F.col("_place") + F.col("_shift")).cast("int").alias(name))


def rank_channels(channel: DataFrame) -> DataFrame:
    """``rank_in_region``: channels of a region by total views; titles settle ties."""
    order = [F.col("total_views").desc(), F.col("channel_title").asc_nulls_last()]
    return number_rows(channel, ["region"], order, "rank_in_region")
