"""Readers of the raw and of the refined layers."""

from trendmark.sources.csv_snapshots import read_csv_inferred, read_csv_snapshots
from trendmark.sources.documents import (
    arrival_of,
    explode_documents,
    parse_documents,
    read_documents,
    split_corrupt,
)
from trendmark.sources.tables import TableStore, sample, spread, with_columns_of

__all__ = [
    "TableStore",
    "arrival_of",
    "explode_documents",
    "parse_documents",
    "read_csv_inferred",
    "read_csv_snapshots",
    "read_documents",
    "sample",
    "split_corrupt",
    "spread",
    "with_columns_of",
]
