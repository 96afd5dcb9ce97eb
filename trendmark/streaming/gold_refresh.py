"""Gold kept up to date by what batches have changed.

A batch leaves the days and channels it has touched. Trending and category rows are made anew for these days, from the
folders of these days alone; channel rows are made anew for these channels, from the days of their regions. Rows of other
days and channels are taken over from Gold. Ranks are given anew in each touched region, over its channel rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from trendmark.config import CATEGORY, CHANNEL, REFERENCE, STATISTICS, TRENDING, QualityRules
from trendmark.operators.broadcasting import broadcast_if_small
from trendmark.operators.cleanse import with_audit
from trendmark.operators.quality import run_checks, verdict
from trendmark.operators.ranking import rank_channels
from trendmark.operators.rollups import CHANNEL_KEY, DAY, channel_rollup
from trendmark.plans.gold import enrich, gold_category, gold_trending
from trendmark.schemas import GOLD, SILVER_STATISTICS
from trendmark.sinks.staged import Stage
from trendmark.sinks.tables import register, write_partitioned
from trendmark.sources.folders import partition_folders, read_folders
from trendmark.sources.tables import TableStore
from trendmark.streaming.upsert import SnapshotUpsert

REGION = ("region",)


def same_keys(df: DataFrame, keys: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Rows of ``df`` that have (``left_semi``) or lack (``left_anti``) one of some distinct keys; NULL equals NULL."""
    renamed = broadcast_if_small(keys.select(*[F.col(name).alias(f"_{name}") for name in names]).distinct())
    same = F.lit(True)
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return df.join(renamed, same, how)


class GoldRefresh:
    """Brings Gold up to date with what an upsert has touched, if the touched rows pass their checks.

    Each table is staged in full, marked, and only then swapped in; a refresh that stops half-way is finished from its
    stages. What does not pass stays pending and is looked at again with the next batch. Equal to a full rebuild of Gold.
    """

    def __init__(self, upsert: SnapshotUpsert, silver: TableStore, gold: TableStore, rules: QualityRules | None = None, now: datetime | None = None):
        self.upsert, self.silver, self.gold, self.now = upsert, silver, gold, now
        self.rules = rules or QualityRules()
        self.staging = f"{upsert.staging}/gold"

    def _stage(self, name: str) -> Stage:
        return Stage(self.silver.spark, f"{self.staging}/{name}", REGION)

    def __call__(self) -> Row | None:
        """The verdict on the touched days; None where nothing is pending."""
        spark = self.silver.spark
        plan = Stage(spark, f"{self.staging}/plan", ())
        if plan.finished:  # stages are complete, the swap was not
            self._swap(plan)
        batches = self.upsert.pending(spark)
        if not batches:
            return None
        touched, folders = self.upsert.touched(spark, batches)
        days = read_folders(spark, self.silver.path(STATISTICS), folders, SILVER_STATISTICS)
        found = verdict(run_checks(spark, {STATISTICS: lambda: days}, self.rules, self.now)).first()
        if found.quality_passed:
            self._build(touched, days, sorted({folder.partition("/")[0] for folder in folders}))
            spark.createDataFrame([(name,) for name in batches], "batch string").write.mode("overwrite").parquet(plan.path)
            plan.mark()
            self._swap(plan)
        return found

    def _build(self, touched: DataFrame, days: DataFrame, regions: list[str]) -> None:
        reference = self.silver.read_if_present(REFERENCE, True)
        rows = read_folders(self.silver.spark, self.silver.path(STATISTICS), regions, SILVER_STATISTICS)
        channels = channel_rollup(enrich(same_keys(rows, touched, CHANNEL_KEY, "left_semi"), reference))
        channels = channels.unionByName(self._kept(CHANNEL, touched, CHANNEL_KEY, regions).select(*channels.columns))
        trending = gold_trending(days, self.now, stored=True).unionByName(self._kept(TRENDING, touched, DAY, regions))
        category = gold_category(enrich(days, reference), self.now, stored=True).unionByName(self._kept(CATEGORY, touched, DAY, regions))
        self._stage(TRENDING).write(trending)
        self._stage(CHANNEL).write(with_audit(rank_channels(channels), "_aggregated_at", self.now))
        self._stage(CATEGORY).write(category)

    def _kept(self, name: str, touched: DataFrame, keys: Sequence[str], regions: list[str]) -> DataFrame:
        """Gold rows of the touched regions whose key is not touched."""
        path = self.gold.path(name)
        present = partition_folders(self.gold.spark, path, 1, regions)
        return same_keys(read_folders(self.gold.spark, path, present, GOLD[name]), touched, keys, "left_anti")

    def _swap(self, plan: Stage) -> None:
        spark = self.silver.spark
        for name in (TRENDING, CHANNEL, CATEGORY):
            rows = self._stage(name).read(GOLD[name])
            write_partitioned(rows, self.gold.path(name), REGION, rebalance=False)
            if self.gold.database is not None:
                register(self.gold, name, REGION, rows.schema, rows.select("region").distinct().collect())
        self.upsert.discard_touched(spark, [row.batch for row in spark.read.parquet(plan.path).collect()])
        plan.discard()


class IncrementalMedallion:
    """Micro-batch handler: rows into Silver, and Gold after them."""

    def __init__(self, silver: TableStore, gold: TableStore, checkpoint: str, job_name: str, rules: QualityRules | None = None, now: datetime | None = None):
        self.upsert = SnapshotUpsert(silver, checkpoint, job_name, now, keep_touched=True)
        self.refresh = GoldRefresh(self.upsert, silver, gold, rules, now)
        self.verdict: Row | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.upsert(batch, batch_id)
        self.verdict = self.refresh()
