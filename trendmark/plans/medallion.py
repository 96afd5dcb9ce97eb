"""The whole run: Bronze to Silver, quality gate, Silver to Gold."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from trendmark.config import CATEGORY, CHANNEL, REFERENCE, STATISTICS, TRENDING, QualityRules
from trendmark.operators.cleanse import with_audit
from trendmark.operators.quality import run_checks, verdict
from trendmark.operators.reference import refine_reference
from trendmark.operators.validation import category_checks, has_content, judged_categories, quarantined_categories
from trendmark.plans.gold import enrich, gold_category, gold_channel, gold_trending
from trendmark.plans.silver import StageCounts, combine_sources, silver_statistics, with_bucket
from trendmark.schemas import BUCKET, CATEGORY_ITEM, SILVER_STATISTICS, VIDEO_ITEM
from trendmark.session import durable
from trendmark.sinks.tables import publish
from trendmark.sources import (
    TableStore,
    explode_documents,
    read_csv_snapshots,
    read_documents,
    split_corrupt,
)

QUARANTINE = "quarantined_documents"
REFUSED_CATEGORIES = "quarantined_categories"


@dataclass(frozen=True)
class MedallionConfig:
    """Where a run reads and writes.

    Split the statistics by ``DAY_PARTITIONS`` if incremental runs are to follow.
    """

    silver: TableStore
    gold: TableStore
    csv_path: str | None = None
    documents_path: str | None = None
    categories_path: str | None = None
    regions: Sequence[str] | None = None
    multi_line: bool = True
    statistics_partitions: Sequence[str] = ("region",)
    job_name: str = "medallion"
    rules: QualityRules = field(default_factory=QualityRules)
    checked_tables: Sequence[str] = (STATISTICS, REFERENCE)


@dataclass(frozen=True)
class RunResult:
    """What a run did: its counts, the verdict row, whether Gold was built, and what category rules found."""

    counts: dict[str, int]
    verdict: Row
    gold_built: bool
    category_checks: list[Row] = field(default_factory=list)

    @property
    def failed_checks(self) -> list[Row]:
        return [check for check in self.verdict.details if not check.passed]


class QualityGateError(RuntimeError):
    """Silver did not pass its checks; Gold was left as it was."""


def build_silver_statistics(spark: SparkSession, config: MedallionConfig, now: datetime | None = None) -> dict[str, int]:
    """Read both kinds of snapshots and write clean statistics; without a source nothing is written.

    Documents that cannot be parsed are written to the table ``QUARANTINE`` of Silver and counted.
    """
    csv_rows = json_items = quarantined = None
    if config.csv_path:
        csv_rows = read_csv_snapshots(spark, config.csv_path, config.regions, config.multi_line)
    if config.documents_path:
        readable, corrupt = split_corrupt(read_documents(spark, config.documents_path, VIDEO_ITEM, config.multi_line))
        quarantined = Observation("quarantined")
        corrupt = corrupt.observe(quarantined, F.count(F.lit(1)).alias("rows"))
        corrupt.write.mode("overwrite").parquet(config.silver.path(QUARANTINE))
        json_items = explode_documents(readable, VIDEO_ITEM)
    normalised = combine_sources(csv_rows, json_items)
    if normalised is None:
        return {}
    counts = StageCounts()
    clean = silver_statistics(counts.watch_raw(normalised), config.job_name, now)
    if BUCKET in config.statistics_partitions:
        clean = with_bucket(clean)
    publish_statistics(counts.watch_clean(clean), config)
    found = counts.report()
    return found if quarantined is None else found | {"corrupt_documents": quarantined.get["rows"]}


def publish_statistics(clean: DataFrame, config: MedallionConfig) -> None:
    """Write deduplicated statistics.

    Split by region alone, they are written as the deduplication has dealt them out, evenly whatever the regions: up to a file
    for each task and region, and no second shuffle of all rows. Other layouts have many more folders and are rebalanced.
    """
    rebalance = tuple(config.statistics_partitions) != ("region",)
    publish(clean, config.silver, STATISTICS, config.statistics_partitions, rebalance)


def build_silver_reference(spark: SparkSession, config: MedallionConfig, now: datetime | None = None) -> list[Row]:
    """Write the reference table; what breaks a rule is refused to ``REFUSED_CATEGORIES`` or reported.

    Returns the check row of each rule. They do not close the gate: a bad document spoils no other.
    """
    if not config.categories_path:
        return []
    documents = read_documents(spark, config.categories_path, CATEGORY_ITEM, config.multi_line)
    judged = durable(judged_categories(documents))
    quarantined_categories(judged).write.mode("overwrite").parquet(config.silver.path(REFUSED_CATEGORIES))
    readable, _ = split_corrupt(documents)
    rows = refine_reference(readable.filter(has_content()))
    publish(with_audit(rows, "_ingestion_timestamp", now, as_text=True), config.silver, REFERENCE)
    return category_checks(judged).collect()


def check_silver(spark: SparkSession, config: MedallionConfig, as_of: datetime | None = None) -> DataFrame:
    """Check rows of the Silver tables."""
    readers = {name: (lambda table=name: config.silver.read(table, True)) for name in config.checked_tables}
    return run_checks(spark, readers, config.rules, as_of)


def build_gold(config: MedallionConfig, now: datetime | None = None) -> None:
    statistics = config.silver.read(STATISTICS, schema=SILVER_STATISTICS)
    enriched = enrich(statistics, config.silver.read_if_present(REFERENCE, True))
    publish(gold_trending(statistics, now, stored=True), config.gold, TRENDING)
    publish(gold_channel(enriched, now, stored=True), config.gold, CHANNEL)
    publish(gold_category(enriched, now, stored=True), config.gold, CATEGORY)


def gate(checks: DataFrame) -> Row:
    """The verdict row, or an error naming the failed checks. Only this one row comes to the driver."""
    found = verdict(checks).first()
    if not found.quality_passed:
        failed = [f"{check.table}.{check.check}: {check.message}" for check in found.details if not check.passed]
        raise QualityGateError("; ".join(failed))
    return found


def run_medallion(
    spark: SparkSession,
    config: MedallionConfig,
    now: datetime | None = None,
    raise_on_failure: bool = False,
) -> RunResult:
    """One full run. Gold is built only if every check passes."""
    counts = build_silver_statistics(spark, config, now)
    categories = build_silver_reference(spark, config, now)
    checks = check_silver(spark, config, now)
    if raise_on_failure:
        found = gate(checks)
    else:
        found = verdict(checks).first()
    if found.quality_passed:
        build_gold(config, now)
    return RunResult(counts, found, found.quality_passed, categories)


__all__ = [
    "MedallionConfig",
    "QualityGateError",
    "RunResult",
    "build_gold",
    "build_silver_reference",
    "build_silver_statistics",
    "check_silver",
    "gate",
    "publish_statistics",
    "run_medallion",
]
