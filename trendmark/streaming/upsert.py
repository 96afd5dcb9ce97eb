"""Keep-latest across runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmark.config import STATISTICS
from trendmark.operators.cleanse import with_ratios
from trendmark.operators.dedup import SNAPSHOT_KEY, keep_latest_snapshot
from trendmark.plans.silver import settled_statistics, with_bucket
from trendmark.schemas import BUCKET, SILVER_BY_DAY, SILVER_STATISTICS
from trendmark.sinks.staged import Stage
from trendmark.sinks.tables import register, write_partitioned
from trendmark.sources.folders import partition_folders, path_exists, read_folders
from trendmark.sources.tables import TableStore

# The incremental table is also split by day, so that a batch rewrites the days it holds and no others.
# Rows without a day are split by bucket besides.
DAY_PARTITIONS = ("region", "trending_date_parsed", BUCKET)

#: What a batch has changed: its days, and the channels whose rows came or went.
TOUCHED = T.StructType([*[f for f in SILVER_STATISTICS.fields if f.name == "channel_title"], *SILVER_STATISTICS.fields[-2:]])



def rows_of_folders(store: TableStore, folders: list[str]) -> DataFrame:
    """Silver rows of some days, given as partition folders; days the table does not have yet give none."""
    path = store.path(STATISTICS)
    return read_folders(store.spark, path, partition_folders(store.spark, path, len(DAY_PARTITIONS), folders), SILVER_BY_DAY)


def touched_rows(fresh: DataFrame, present: DataFrame) -> DataFrame:
    """Region, day and channel of every fresh row, and of every present row that has a fresh row's key."""
    names = TOUCHED.fieldNames()
    keys = fresh.select(*[F.col(name).alias(f"_{name}") for name in SNAPSHOT_KEY]).distinct()
    same = F.lit(True)
    for name in SNAPSHOT_KEY:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return fresh.select(*names).unionByName(present.join(keys, same, "left_semi").select(*names)).distinct()


class SnapshotUpsert:
    """Micro-batch handler that merges normalised rows into the Silver statistics table.

    A batch is settled and staged, merged with the rows of the days it touches, staged again, and only
    then swapped in. Both stages are keyed by batch: a run that stops half-way through the swap repeats
    it from what is left in the finished stage, so no row is lost or doubled; files are moved, not written again. Batches may come in any order, since the
    arrival time is kept with each row.

    The staged batch's own folders say which days it touches. These are listed, read, replaced and added to the catalog;
    what the table holds besides costs nothing.

    With ``keep_touched`` the days and channels of each batch are kept until ``discard_touched``.
    """

    def __init__(self, store: TableStore, checkpoint: str, job_name: str, now: datetime | None = None, keep_touched: bool = False):
        self.store = store
        # Batch numbers belong to one checkpoint, so the stages lie inside it.
        self.staging = f"{checkpoint.rstrip('/')}/staged"
        self.job_name = job_name
        self.now = now
        self.keep_touched = keep_touched

    def _stage(self, spark: SparkSession, name: str, batch_id: int) -> Stage:
        return Stage(spark, f"{self.staging}/{name}-{batch_id}", DAY_PARTITIONS)

    def _touched(self, spark: SparkSession, kind: str, batch: str) -> Stage:
        return Stage(spark, f"{self.staging}/touched-{kind}/batch={batch}", ())

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh, merged = (self._stage(spark, name, batch_id) for name in ("fresh", "merged"))
        if not merged.finished:
            if not fresh.finished:
                # Neither deduplicated nor gathered: the merge does both.
                fresh.write(with_bucket(settled_statistics(batch, self.job_name, self.now)), rebalance=False)
            rows = fresh.read(SILVER_BY_DAY)
            present = rows_of_folders(self.store, fresh.folders())
            if self.keep_touched:
                touched_rows(rows, present).write.mode("overwrite").parquet(self._touched(spark, "rows", str(batch_id)).path)
                days = sorted({folder.rpartition("/")[0] for folder in fresh.folders()})  # with all buckets
                folders = spark.createDataFrame([(day,) for day in days], "folder string")
                folders.write.mode("overwrite").parquet(self._touched(spark, "days", str(batch_id)).path)
            # Ratios are derived from the rows that stay, after these are gathered, so that no shuffle holds them.
            kept = keep_latest_snapshot(present.unionByName(rows).drop("like_ratio", "engagement_rate"))
            gathered = kept.hint("rebalance", *[F.col(name) for name in DAY_PARTITIONS])
            merged.write(with_ratios(gathered).select(*SILVER_BY_DAY.fieldNames()), rebalance=False)
        rows = merged.read(SILVER_BY_DAY)
        write_partitioned(rows, self.store.path(STATISTICS), DAY_PARTITIONS, rebalance=False, staged=merged.path)
        if self.store.database is not None:
            # A row for each day of the batch. The merged rows have moved by now, the fresh ones lie in the same folders.
            days = fresh.read(SILVER_BY_DAY).select(*DAY_PARTITIONS).distinct().collect()
            register(self.store, STATISTICS, DAY_PARTITIONS, rows.schema, days)
        days = self._touched(spark, "days", str(batch_id))
        if self.keep_touched and path_exists(spark, days.path):
            days.mark()  # from here on Gold may follow
        for name in ("fresh", "merged"):
            self._stage(spark, name, batch_id - 1).discard()

    def pending(self, spark: SparkSession) -> list[str]:
        """Batches in Silver whose days and channels are kept."""
        root = f"{self.staging}/touched-days"
        names = [folder.removeprefix("batch=") for folder in partition_folders(spark, root, 1)]
        return [name for name in names if self._touched(spark, "days", name).finished]

    def touched(self, spark: SparkSession, batches: list[str]) -> tuple[DataFrame, list[str]]:
        """Region, day and channel of what some batches have touched, and the partition folders of their days."""
        rows = spark.read.schema(TOUCHED).parquet(*[self._touched(spark, "rows", name).path for name in batches])
        days = spark.read.schema("folder string").parquet(*[self._touched(spark, "days", name).path for name in batches])
        return rows, sorted(row.folder for row in days.distinct().collect())

    def discard_touched(self, spark: SparkSession, batches: list[str]) -> None:
        for name in batches:
            for kind in ("days", "rows"):
                self._touched(spark, kind, name).discard()
