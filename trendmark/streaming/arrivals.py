"""File streams over the raw layer."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmark.config import REFERENCE
from trendmark.operators.cleanse import with_audit
from trendmark.operators.dedup import SNAPSHOT_KEY, keep_first
from trendmark.operators.normalize import ARRIVED_AT, normalize_json
from trendmark.operators.reference import newest_document, refine_reference
from trendmark.operators.validation import has_content
from trendmark.schemas import CORRUPT, CSV_FILE, VIDEO_ITEM, document_schema
from trendmark.session import durable, ready
from trendmark.sinks.staged import Stage
from trendmark.sinks.tables import publish, write_partitioned
from trendmark.sources.csv_headers import CSV_GLOB, RECORD, cells_by_name, with_further_cells
from trendmark.sources.csv_snapshots import snapshot_file_columns
from trendmark.sources.documents import JSON_GLOB, explode_documents, split_corrupt, with_file_columns
from trendmark.sources.folders import partition_folders, path_exists, read_folders
from trendmark.sources.tables import TableStore


def stream_csv_snapshots(
    spark: SparkSession, path: str, max_files: int | None = None, multi_line: bool = True, width: int = 64
) -> DataFrame:
    """CSV snapshots as they land, shaped like the batch reader's rows.

    Each file is read whole by one task, which takes its columns by the names in the file's header: in any order and case,
    NULL where the file lacks one. A file with more than ``width`` columns ends the run. Without ``multi_line`` files
    are split, and a header that is not the expected one ends the run.
    """
    reader = spark.readStream.option("multiLine", multi_line).option("escape", '"')
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", CSV_GLOB)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    wanted = CSV_FILE.fieldNames()
    if not multi_line:
        strict = reader.schema(CSV_FILE).option("header", True).option("enforceSchema", False).csv(path)
        return strict.select(*wanted, *snapshot_file_columns())
    expected = min(len(wanted), width + 1)
    read = T.StructType([T.StructField(name, T.StringType()) for name in (*(f"c{i}" for i in range(expected)), RECORD)])
    rows = reader.schema(read).option("columnNameOfCorruptRecord", RECORD).option("header", False).csv(path)
    rows = rows.select(*read.fieldNames(), *snapshot_file_columns(), F.col("_metadata.file_path").alias("source"))
    rows = with_further_cells(rows, expected, width, {"escape": '"'})
    return cells_by_name(rows, expected, wanted, width).drop("source")


def stream_documents(
    spark: SparkSession, path: str, item: T.StructType, max_files: int | None = None, multi_line: bool = True
) -> DataFrame:
    """Raw API documents as they land, shaped like the batch reader's rows."""
    reader = (
        spark.readStream.schema(document_schema(item))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", JSON_GLOB)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_file_columns(reader.json(path), item)


def run_available(
    stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str, name: str | None = None
) -> None:
    """Process every file not seen by this checkpoint yet, then stop."""
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer.trigger(availableNow=True).start().awaitTermination()


def first_seen(snapshots: DataFrame, delay: str = "48 hours") -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of the first, with state bounded by it.

    The first arrival stays; use the upsert where the latest must.
    """
    return snapshots.withWatermark(ARRIVED_AT, delay).dropDuplicatesWithinWatermark(list(SNAPSHOT_KEY))


class ReferenceArrivals:
    """Handler of new category documents: good ones refresh their region, bad ones go to quarantine.

    A document older than the one its region has is ignored, whichever batch brings it.
    """

    def __init__(self, store: TableStore, quarantine: str, now: datetime | None = None):
        self.store = store
        self.quarantine = quarantine
        self.now = now

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        readable, corrupt = split_corrupt(batch)
        # Keyed by batch, so that a repeated batch replaces its own rows.
        corrupt.write.mode("overwrite").parquet(f"{self.quarantine.rstrip('/')}/batch={batch_id}")
        rows = with_audit(
            refine_reference(readable.filter(has_content())), "_ingestion_timestamp", self.now, as_text=True
        )
        present = self.store.read_if_present(REFERENCE, True)
        if present is not None:
            # Written apart first: the table cannot be replaced while it is read.
            rows = durable(newest_document(rows.unionByName(present, allowMissingColumns=True)))
        publish(rows, self.store, REFERENCE)


class VideoArrivals:
    """Handler of new video documents: rows of readable ones go to ``handler``, the others to quarantine.

    Both outputs are keyed by batch, so that a repeated batch replaces its own. Each reads the batch's files itself: nothing
    is kept in memory. Both read every field, so that they agree on which documents are unreadable.
    """

    def __init__(self, handler: Callable[[DataFrame, int], None], quarantine: str):
        self.handler = handler
        self.quarantine = quarantine.rstrip("/")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        readable, corrupt = split_corrupt(batch.filter(_every_field()))
        corrupt.write.mode("overwrite").parquet(f"{self.quarantine}/batch={batch_id}")
        self.handler(normalize_json(explode_documents(readable, VIDEO_ITEM)), batch_id)


def _every_field() -> Column:
    """True, but known only from all fields of a document: a reader that leaves some out takes worse documents for readable."""
    return F.concat(*[F.col(name).isNull().cast("string") for name in document_schema(VIDEO_ITEM).fieldNames()]) != ""


class FirstArrivals:
    """Handler that keeps the first arrival of each key, those on time apart from those that come late.

    A row is late if it arrived more than ``delay`` before the latest arrival of earlier batches. What was seen is kept by key
    in a table split by lateness, region and day, where a batch has folders of its own: a repeated batch replaces them,
    and a batch reads only the days it holds. No key is forgotten, so a late repeat is dropped like any other, and a late
    first arrival is never lost.
    """

    SPLIT = ("late", "region", "trending_date_parsed", "batch")

    def __init__(self, root: str, delay: str = "48 hours"):
        self.root, self.delay = root.rstrip("/"), delay
        self.path = f"{self.root}/arrivals"
        self.schema = T.StructType.fromDDL(
            f"video_id string, {ARRIVED_AT} timestamp, late boolean, region string, trending_date_parsed date, batch bigint"
        )

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived = Observation()  # the latest arrival comes with the write; a maximum stays right if a task is repeated
        every = batch.select(*SNAPSHOT_KEY, ARRIVED_AT).observe(arrived, F.max(ARRIVED_AT).alias("latest"))
        first = keep_first(every, SNAPSHOT_KEY, [F.col(ARRIVED_AT).asc_nulls_last()])
        staged = Stage(spark, f"{self.root}/staged", ("region", "trending_date_parsed"))
        staged.write(first)
        rows = spark.read.schema(_without(self.schema, "late", "batch")).parquet(staged.path)
        folders = [f"late={late}/{folder}" for late in ("false", "true") for folder in staged.folders()]
        present = read_folders(spark, self.path, partition_folders(spark, self.path, 3, folders), self.schema)
        seen = present.filter(F.col("batch") < batch_id).select(*[F.col(name).alias(f"_{name}") for name in SNAPSHOT_KEY])
        same = F.lit(True)
        for name in SNAPSHOT_KEY:
            same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
        limit = self._latest(spark, batch_id)
        late = F.lit(False) if limit is None else F.coalesce(F.col(ARRIVED_AT) < F.lit(limit) - F.expr(f"INTERVAL {self.delay}"), F.lit(False))
        unseen = rows.join(seen, same, "left_anti").withColumns({"late": late, "batch": F.lit(batch_id).cast("bigint")})
        write_partitioned(unseen, self.path, self.SPLIT)
        self._mark(spark, batch_id, arrived.get["latest"], limit)

    def _marks(self, batch_id: int) -> str:
        return f"{self.root}/latest/batch={batch_id}"

    def _latest(self, spark: SparkSession, batch_id: int) -> datetime | None:
        """The latest arrival of earlier batches."""
        path = self._marks(batch_id - 1)
        return spark.read.schema("latest timestamp").parquet(path).first().latest if path_exists(spark, path) else None

    def _mark(self, spark: SparkSession, batch_id: int, latest: datetime | None, before: datetime | None) -> None:
        known = max((moment for moment in (latest, before) if moment is not None), default=None)
        spark.createDataFrame([(known,)], "latest timestamp").coalesce(1).write.mode("overwrite").parquet(self._marks(batch_id))

    def read(self, spark: SparkSession, late: bool) -> DataFrame:
        """First arrivals that were on time, or late."""
        return spark.read.schema(self.schema).parquet(self.path).filter(F.col("late") == late).drop("late", "batch")


def _without(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([field for field in schema.fields if field.name not in names])
