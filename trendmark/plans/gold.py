"""Silver to Gold.

The three tables are three plans over the Silver table. Each reads the few columns it needs, so reading
Silver again is cheaper than keeping the joined rows, and nothing is lost with an executor. Where Silver is ``stored``,
written and not still to be made, each distinct count reads it again for its own columns.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from trendmark.operators.cleanse import with_audit
from trendmark.operators.lookup import attach_category_names, category_lookup
from trendmark.operators.ranking import rank_channels
from trendmark.operators.rollups import category_rollup, channel_rollup, trending_rollup, with_view_share


def enrich(statistics: DataFrame, reference: DataFrame | None) -> DataFrame:
    """Statistics with category names; without reference data every name is ``Unknown``."""
    return attach_category_names(statistics, None if reference is None else category_lookup(reference))


def gold_trending(statistics: DataFrame, now: datetime | None = None, stored: bool = False) -> DataFrame:
    return with_audit(trending_rollup(statistics, stored=stored), "_aggregated_at", now)


def gold_channel(enriched: DataFrame, now: datetime | None = None, stored: bool = False) -> DataFrame:
    return with_audit(rank_channels(channel_rollup(enriched, stored)), "_aggregated_at", now)


def gold_category(enriched: DataFrame, now: datetime | None = None, stored: bool = False) -> DataFrame:
    return with_audit(with_view_share(category_rollup(enriched, stored)), "_aggregated_at", now)
