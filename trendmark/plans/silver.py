"""Bronze to Silver."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from trendmark.functions import clean_region, parse_trending_date
from trendmark.operators.cleanse import settle, with_audit, with_ratios
from trendmark.operators.dedup import SNAPSHOT_KEY, keep_latest_snapshot
from trendmark.operators.normalize import normalize_csv, normalize_json, union_sources
from trendmark.operators.quality import warning_metrics
from trendmark.schemas import BUCKET

WATCHED = ["video_id", "title", "channel_title", "views"]


def silver_statistics(normalised: DataFrame, job_name: str, now: datetime | None = None) -> DataFrame:
    """Normalised rows of any sources to clean statistics: one narrow stage and one shuffle.

    What is derived from a row is added after the shuffle.
    """
    return _audited(with_ratios(keep_latest_snapshot(settle(normalised))), job_name, now)


def settled_statistics(normalised: DataFrame, job_name: str, now: datetime | None = None) -> DataFrame:
    """The same rows with their repeats and without ratios, for a merge that keeps the latest: one narrow stage."""
    return _audited(settle(normalised), job_name, now)


def _audited(statistics: DataFrame, job_name: str, now: datetime | None) -> DataFrame:
    return with_audit(statistics, "_processed_at", now, _job_name=job_name)


#: Folders that the rows of a region without a day are spread over.
UNDATED_BUCKETS = 64


def with_bucket(statistics: DataFrame) -> DataFrame:
    """Adds the bucket that tables split by day use: 0 for rows with a day, by video for those without."""
    undated = F.col("trending_date_parsed").isNull()
    bucket = F.pmod(F.xxhash64("video_id"), F.lit(UNDATED_BUCKETS)).cast("int")
    return statistics.withColumn(BUCKET, F.when(undated, bucket).otherwise(0))


def combine_sources(csv_rows: DataFrame | None, json_items: DataFrame | None) -> DataFrame | None:
    """Normalise and unite whichever sources there are."""
    parts = []
    if csv_rows is not None:
        parts.append(normalize_csv(csv_rows))
    if json_items is not None:
        parts.append(normalize_json(json_items))
    return union_sources(*parts) if parts else None


class StageCounts:
    """Row and warning counts of a run, gathered by the write itself instead of by extra passes.

    They are for the run's report. A task repeated after a loss can be counted twice, so nothing is
    decided by them; the quality gate aggregates the written table.
    """

    def __init__(self) -> None:
        self._raw = Observation("raw")
        self._clean = Observation("clean")

    def watch_raw(self, df: DataFrame) -> DataFrame:
        return df.observe(self._raw, F.count(F.lit(1)).alias("rows"), *warning_metrics(WATCHED))

    def watch_clean(self, df: DataFrame) -> DataFrame:
        return df.observe(self._clean, F.count(F.lit(1)).alias("rows"))

    def report(self) -> dict[str, int]:
        """Counts of the finished write; waits for it if it is still running."""
        counts = {f"raw_{name}": value for name, value in self._raw.get.items()}
        counts.update({f"clean_{name}": value for name, value in self._clean.get.items()})
        return counts


def stage_row_counts(normalised: DataFrame) -> DataFrame:
    """Exact row counts before and after cleansing and deduplication, in one pass over the three key columns."""
    keys = normalised.select(
        "video_id",
        clean_region(F.col("region")).alias("region"),
        parse_trending_date(F.col("trending_date")).alias("trending_date_parsed"),
    )
    copies = keys.groupBy(*SNAPSHOT_KEY).agg(F.count("*").alias("copies"))
    keyed = F.col("video_id").isNotNull()
    counts = copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("read"),
        F.coalesce(F.sum(F.when(keyed, F.col("copies"))), F.lit(0)).alias("cleansed"),
        F.count_if(keyed).alias("deduplicated"),
    )
    return counts.unpivot([], ["read", "cleansed", "deduplicated"], "stage", "rows")
