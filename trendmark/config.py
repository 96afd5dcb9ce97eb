"""Settings, as plain dataclasses."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

STATISTICS = "clean_statistics"
REFERENCE = "clean_reference_data"
TRENDING = "trending_analytics"
CHANNEL = "channel_analytics"
CATEGORY = "category_analytics"

UNKNOWN = "Unknown"
UNKNOWN_REGION = "unknown"


@dataclass(frozen=True)
class ValueRange:
    """Inclusive bounds of a numeric column."""

    column: str
    low: int
    high: int


@dataclass(frozen=True)
class TableRules:
    """What the quality suite expects of one table."""

    critical_columns: tuple[str, ...]
    ranges: tuple[ValueRange, ...] = ()


@dataclass(frozen=True)
class QualityRules:
    """Thresholds of the quality suite; the defaults are fixed values."""

    min_rows: int = 10
    max_null_pct: float = 5.0
    freshness_hours: int = 48
    freshness_columns: tuple[str, ...] = ("_processed_at", "_ingestion_timestamp")
    sample_rows: int | None = None
    tables: Mapping[str, TableRules] = field(
        default_factory=lambda: {
            STATISTICS: TableRules(
                ("video_id", "title", "channel_title", "views", "region"),
                (ValueRange("views", 0, 50_000_000_000),),
            ),
            REFERENCE: TableRules(("id", "region")),
        }
    )
