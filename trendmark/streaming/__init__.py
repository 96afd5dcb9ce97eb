"""Incremental runs: only files not seen before are processed."""

from trendmark.streaming.arrivals import (
    FirstArrivals,
    ReferenceArrivals,
    VideoArrivals,
    first_seen,
    run_available,
    stream_csv_snapshots,
    stream_documents,
)
from trendmark.streaming.gold_refresh import GoldRefresh, IncrementalMedallion
from trendmark.streaming.upsert import SnapshotUpsert

__all__ = [
    "FirstArrivals",
    "GoldRefresh",
    "IncrementalMedallion",
    "ReferenceArrivals",
    "SnapshotUpsert",
    "VideoArrivals",
    "first_seen",
    "run_available",
    "stream_csv_snapshots",
    "stream_documents",
]
