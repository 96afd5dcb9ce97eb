from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rows import raw
from trendmark.operators import broadcasting
from trendmark.operators.cleanse import cleanse
from trendmark.operators.lookup import attach_category_names, category_lookup
from trendmark.operators.ranking import number_rows, rank_channels
from trendmark.operators.rollups import (
    category_rollup,
    channel_rollup,
    ingestion_summary,
    top_channels,
    trending_rollup,
    with_view_share,
)
from trendmark.plans.gold import enrich, gold_channel
from trendmark.schemas import SILVER_STATISTICS
from trendmark.workload.queries import QUERIES, enriched, silver


def reference(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, `snippet.title` string, region string")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_takes_one_name_per_id(spark):
    found = category_lookup(reference(spark, ("10", "Music", "us"), ("10", "Musik", "de"), ("x", "bad", "us"), ("11", None, "aa"), ("11", "Z", "zz")))
    assert {(r.category_id, r.category_name) for r in found.collect()} == {(10, "Musik"), (None, "bad"), (11, "Z")}


def test_lookup_join_keeps_every_row(spark):
    rows = raw(spark, {"category_id": 10}, {"category_id": 25}, {"category_id": None})
    named = enrich(rows, reference(spark, ("10", "Music", "us"), ("10", "M", "us")))
    assert sorted((str(r.category_id), r.category_name) for r in named.collect()) == [
        ("10", "M"), ("25", "Unknown"), ("None", "Unknown")
    ]
    assert "BroadcastHashJoin" in plan_of(named)


@pytest.mark.parametrize("shape", ["no reference", "no title"])
def test_missing_reference_means_unknown(spark, shape):
    given = None if shape == "no reference" else reference(spark, ("10", "M", "us")).drop("snippet.title")
    assert {r.category_name for r in enrich(raw(spark, {}, {}), given).collect()} == {"Unknown"}


def test_large_sides_are_not_broadcast(spark, monkeypatch):
    lookup = category_lookup(reference(spark, *[(str(i), "n", "us") for i in range(20)]))
    small = broadcasting.broadcast_if_small(lookup, max_rows=20)
    assert "Hint broadcast" in small._jdf.queryExecution().logical().toString()
    for limits in ({"max_rows": 19}, {"max_bytes": 10}):
        large = broadcasting.broadcast_if_small(lookup, **limits)
        assert "Hint broadcast" not in large._jdf.queryExecution().logical().toString()
    monkeypatch.setattr("trendmark.operators.lookup.broadcast_if_small", lambda df: df)
    rows = raw(spark, {"category_id": 3}, {"category_id": None})
    assert sorted(r.category_name for r in attach_category_names(rows, lookup).collect()) == ["Unknown", "n"]


def test_trending_counts_rows_and_channel_counts_videos(spark):
    rows = cleanse(raw(spark, {}, {"trending_date": "17.15.11", "views": 300}, {"video_id": "v2", "channel_title": None}))
    days = {str(r.trending_date_parsed): r for r in trending_rollup(rows).collect()}
    first = days["2017-11-14"]
    assert (first.total_videos, first.unique_channels, first.total_views, first.max_views) == (2, 1, 200, 100)
    channels = {r.channel_title: r for r in gold_channel(enrich(rows, None), datetime(2024, 1, 1)).collect()}
    assert channels["c"].total_videos == 1 and channels["c"].times_trending == 2 and channels["c"].peak_views == 300
    assert channels["c"].categories == ["Unknown"] and channels["c"].rank_in_region == 1
    assert channels[None].total_videos == 1 and channels[None].rank_in_region == 2


def test_unmatched_categories_stay_apart(spark):
    rows = cleanse(raw(spark, {"category_id": 1}, {"category_id": 2}, {"category_id": None}))
    shares = with_view_share(category_rollup(enrich(rows, None))).collect()
    assert len(shares) == 3 and {r.category_name for r in shares} == {"Unknown"}


def test_share_of_a_day_without_views_is_null(spark):
    rows = cleanse(raw(spark, {"views": 0}))
    assert with_view_share(category_rollup(enrich(rows, None))).first().view_share_pct is None


def test_shares_of_a_day_add_up(spark, tiny):
    shares = with_view_share(category_rollup(enriched(spark, tiny)))
    days = shares.groupBy("region", "trending_date_parsed").agg(
        F.sum("view_share_pct").alias("total"), F.count("*").alias("n"), F.sum("total_views").alias("views")
    )
    assert days.filter((F.col("views") > 0) & (F.abs(F.col("total") - 100) > 0.005 * F.col("n") + 1e-6)).count() == 0


@pytest.mark.parametrize("slices", [1, 3, 8])
def test_numbering_spans_slices(spark, slices):
    """One group has most rows; numbers still run from 1 to n in each group, in order."""
    rows = spark.range(5000).select(
        F.when(F.col("id") % 5 == 0, F.concat(F.lit("g"), (F.col("id") % 3).cast("string")))
        .when(F.col("id") % 5 == 1, None)
        .otherwise("hot")
        .alias("g"),
        F.when(F.col("id") % 4 == 0, 0).otherwise(F.col("id") % 97).alias("v"),
        F.col("id").alias("tie"),
    )
    order = [F.col("v").desc(), F.col("tie").asc()]
    spark.conf.set("spark.sql.shuffle.partitions", slices)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_rows(rows, ["g"], order, "n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    groups = {}
    for row in numbered:
        groups.setdefault(row.g, []).append((-row.v, row.tie, row.n))
    assert len(numbered) == 5000 and len(groups) == 5
    for members in groups.values():
        assert [n for _, _, n in sorted(members)] == list(range(1, len(members) + 1))


def test_ranks_run_from_one(spark, tiny):
    ranked = rank_channels(channel_rollup(enriched(spark, tiny)))
    for row in ranked.groupBy("region").agg(
        F.count("*").alias("n"), F.max("rank_in_region").alias("top"), F.countDistinct("rank_in_region").alias("d")
    ).collect():
        assert row.n == row.top == row.d


def test_top_channels_is_ten_at_most(spark):
    rows = cleanse(raw(spark, *[{"channel_title": f"c{i:02}", "views": 100 - i % 3} for i in range(15)]))
    top = top_channels(channel_rollup(enrich(rows, None)), "us")
    assert [r.channel_title for r in top.collect()] == [f"c{i:02}" for i in (0, 3, 6, 9, 12, 1, 4, 7, 10, 13)]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_ingestion_summary(spark):
    payloads = spark.createDataFrame(
        [("r1", "US", 50), ("r1", "GB", 0), ("r2", "US", 3)], "ingestion_id string, region string, video_count int"
    )
    found = {(r.ingestion_id, r.region): (r.succeeded, r.video_count) for r in ingestion_summary(payloads, ["us ", "GB"]).collect()}
    assert found == {("r1", "US"): (True, 50), ("r1", "GB"): (True, 0), ("r2", "US"): (True, 3), ("r2", "GB"): (False, 0)}


def test_gold_reads_only_the_columns_it_needs(spark, folder, tiny):
    from trendmark.sinks import write_partitioned

    write_partitioned(silver(spark, tiny), folder + "/silver")
    statistics = spark.read.schema(SILVER_STATISTICS).parquet(folder + "/silver")
    for df in (trending_rollup(statistics), channel_rollup(enrich(statistics, None)), category_rollup(enrich(statistics, None))):
        plan = plan_of(df)
        assert "description" not in plan and "tags" not in plan and "Python" not in plan
    pruned = plan_of(trending_rollup(statistics.filter(F.col("region") == "eu")))
    assert "PartitionFilters: [isnotnull(region" in pruned


def test_channel_rollup_scans_silver_once(spark, folder):
    rows = raw(spark, *[{"video_id": f"v{i % 7}", "category_id": i % 3, "channel_title": f"c{i % 2}", "views": i} for i in range(50)])
    cleanse(rows).withColumn("category_name", F.concat(F.lit("n"), "category_id")).write.parquet(folder + "/silver")
    found = channel_rollup(spark.read.parquet(folder + "/silver"))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "collect_set" not in plan
    by_channel = {r.channel_title: r for r in found.collect()}
    assert by_channel["c0"].total_videos == 7 and by_channel["c0"].categories == ["n0", "n1", "n2"]
    assert by_channel["c0"].total_views == sum(range(0, 50, 2)) and by_channel["c0"].times_trending == 25


def test_ingestion_summary_reads_payloads_once(spark, tiny):
    payloads = spark.createDataFrame(
        [("r1", "US", 1), ("r1", " us", 2), ("r1", None, 5), (None, "US", 4), ("r2", "US", None)],
        "ingestion_id string, region string, video_count int",
    )
    found = ingestion_summary(payloads, ["us", "GB", "us"])
    assert sorted((str(r.ingestion_id), r.region, r.succeeded, r.video_count) for r in found.collect()) == [
        ("None", "GB", False, 0), *[("None", "US", False, 0)] * 2,
        ("r1", "GB", False, 0), *[("r1", "US", True, 3)] * 2,
        ("r2", "GB", False, 0), *[("r2", "US", False, 0)] * 2,
    ]
    plan = QUERIES["ingestion_summary"](spark, tiny)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
