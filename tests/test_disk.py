"""What a query shuffles and writes besides its result."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rows import raw
from trendmark.config import STATISTICS
from trendmark.operators.cleanse import cleanse
from trendmark.operators.rollups import category_rollup, channel_rollup, trending_rollup
from trendmark.schemas import SILVER_BY_DAY
from trendmark.sinks import tables, write_raw_documents
from trendmark.sinks.staged import Stage
from trendmark.sources import TableStore, folders
from trendmark.streaming import SnapshotUpsert
from trendmark.workload.queries import QUERIES


def test_the_partitioned_sink_shuffles_silver_once(spark, tiny, monkeypatch):
    """Deduplicated rows are written as they were dealt out; gathering them by region would shuffle all of them again."""
    plans, write = [], tables.write_partitioned

    def watched(df, path, partition_by=("region",), rebalance=True):
        plans.append(rebalance)
        write(df, path, partition_by, rebalance)

    monkeypatch.setattr(tables, "write_partitioned", watched)
    found = QUERIES["sink_partitioned_parquet"](spark, tiny)
    assert plans == [False]
    assert found.count() == QUERIES["silver_dedup"](spark, tiny).count() > 5_000


def figures(df):
    """Averages to nine digits: sums of doubles depend on their order."""
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in row]) for row in df.collect())


def test_distinct_counts_of_stored_rows_are_made_apart(spark, folder):
    """The same figures, NULL keys and values too; the rows shuffled for a count hold the count's columns alone."""
    changes = [
        {"video_id": f"v{i % 7}", "region": ["us", "ca", None][i % 3], "trending_date": f"17.{i % 4 + 1:02}.11" if i % 5 else None,
         "channel_title": f"c{i % 11}" if i % 3 and i % 7 else None, "category_id": i % 6 if i % 4 else None, "views": i}
        for i in range(300)
    ]
    cleanse(raw(spark, *changes)).write.parquet(folder + "/rows")
    rows = spark.read.parquet(folder + "/rows").withColumn("category_name", F.concat(F.lit("n"), F.col("category_id") % 4))
    for rollup in (trending_rollup, channel_rollup, category_rollup):
        apart, at_once = rollup(rows, stored=True), rollup(rows)
        assert apart.columns == at_once.columns and apart.dtypes == at_once.dtypes
        assert figures(apart) == figures(at_once)
        plan = apart._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "Generate" not in plan and "count(distinct" not in plan
    assert trending_rollup(rows, stored=True).filter("unique_channels = 0").count() == trending_rollup(rows).filter("unique_channels = 0").count()


def test_texts_are_made_once_for_their_names_and_to_be_written(spark, folder):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        made.add(1)
        return '{"n": ' + str(i) + "}"

    at = F.timestamp_add("SECOND", (F.col("id") % 3).cast("int"), F.lit("2026-07-14 10:00:00").cast("timestamp"))
    texts = spark.range(0, 300, 1, 4).select(text("id").alias("doc"), at.alias("at"))
    write_raw_documents(texts, "doc", F.col("at"), folder + "/raw")
    assert made.value == 300
    found = spark.read.text(folder + "/raw")
    assert found.distinct().count() == 300 == found.count() and found.select("ingestion_id").distinct().count() == 3


def days_of(spark, store):
    read = spark.read.schema(SILVER_BY_DAY).parquet(store.path(STATISTICS))
    return sorted((r.video_id, r.region, str(r.trending_date_parsed), r.views) for r in read.collect())


def test_merged_days_are_moved_into_place(spark, folder, monkeypatch):
    """A stop after some days goes on with the others; what the swap has moved is not written again."""
    store = TableStore(spark, folder + "/silver")
    handler = SnapshotUpsert(store, folder + "/checkpoint", "job", datetime(2024, 2, 1))
    days = ["17.01.11", "17.02.11", None]
    handler(raw(spark, *({"trending_date": d, "region": r, "views": 1} for d in days for r in ("us", "o'x %", "c"))), 0)
    later = raw(spark, *({"trending_date": d, "region": r, "views": 2, "_arrived_at": datetime(2025, 1, 1)} for d in days for r in ("us", "o'x %")))
    real, moved = folders.located, []

    def stop_at_third(spark, path):
        if path.startswith(store.path(STATISTICS)) and "_bucket=" in path:
            moved.append(path)
            if len(moved) == 3:
                raise RuntimeError("driver lost")
        return real(spark, path)

    monkeypatch.setattr(folders, "located", stop_at_third)
    with pytest.raises(RuntimeError):
        handler(later, 1)
    monkeypatch.undo()
    staged = sorted(p.name for p in Path(folder, "checkpoint/staged/merged-1").rglob("part-*.parquet"))
    assert len(staged) == 4  # six days, two of them moved
    for _ in range(2):  # the batch again, and once more
        handler(later, 1)
        found = days_of(spark, store)
        assert len(found) == 9 and all(views == (1 if region == "c" else 2) for _, region, _, views in found)
    assert set(staged) < {p.name for p in Path(store.path(STATISTICS)).rglob("part-*.parquet")}


def test_a_merge_shuffles_no_ratios(spark, folder, monkeypatch):
    """Neither the deduplication nor the gathering by day holds what is derived from a row; present rows keep their figures."""
    plans, write = [], Stage.write

    def watched(stage, df, rebalance=True):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(stage, df, rebalance)

    monkeypatch.setattr(Stage, "write", watched)
    store = TableStore(spark, folder + "/silver")
    handler = SnapshotUpsert(store, folder + "/checkpoint", "job", datetime(2024, 2, 1))
    handler(raw(spark, {"likes": 1, "views": 3}, {"video_id": "v2", "views": 0}, {"video_id": "v3", "likes": None}), 0)
    handler(raw(spark, {"likes": 2, "views": 3, "_arrived_at": datetime(2025, 1, 1)}), 1)
    merges = [plan for plan in plans if "Window [" in plan]
    assert len(merges) == 2
    for plan in merges:
        above, below = plan.split("RebalancePartitions", 1)
        made = [line for line in below.split("\n") if "Relation [" not in line and "LogicalRDD [" not in line]  # not what is read
        assert "engagement_rate" in above and not any("engagement_rate" in line for line in made)
    read = spark.read.schema(SILVER_BY_DAY).parquet(store.path(STATISTICS)).orderBy("video_id").collect()
    assert [(r.likes, r.like_ratio, r.engagement_rate) for r in read] == [(2, 66.6667, 166.6667), (10, 0.0, 0.0), (0, 0.0, 3.0)]
