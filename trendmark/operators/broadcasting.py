"""Broadcasts that are checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 100_000
MAX_BYTES = 16 * 1024 * 1024


def is_small(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Whether ``df`` is measured to be small. The measuring stops one row past the limit."""
    width = sum((F.octet_length(F.col(name).cast("string")) for name in df.columns), F.lit(0))
    head = df.limit(max_rows + 1).agg(F.count("*").alias("rows"), F.sum(F.coalesce(width, F.lit(64))).alias("bytes"))
    found = head.first()
    return found.rows <= max_rows and (found.bytes or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it is measured to be small, else ``df`` as it is.

    Without the hint Spark joins by shuffling both sides, and adaptive execution splits skewed keys.
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df
