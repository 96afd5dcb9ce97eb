from datetime import datetime

import pytest

from rows import raw
from trendmark.config import STATISTICS
from trendmark.plans import medallion
from trendmark.plans.medallion import MedallionConfig, publish_statistics
from trendmark.plans.silver import silver_statistics, with_bucket
from trendmark.sources import TableStore
from trendmark.streaming.upsert import DAY_PARTITIONS

NOW = datetime(2024, 2, 1)


def silver(spark):
    rows = raw(spark, *({"video_id": f"v{i % 50}", "region": [" US ", "gb", None][i % 3], "views": i} for i in range(600)))
    return silver_statistics(rows.repartition(4), "job", NOW)


def test_ratios_are_not_shuffled(spark):
    plan = silver(spark)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Window [", 1)
    assert "like_ratio" in above and "like_ratio" not in below and "engagement_rate" not in below


@pytest.mark.parametrize("layout, rebalances", [(("region",), 0), (tuple(DAY_PARTITIONS), 1)])
def test_silver_split_by_region_is_written_as_deduplicated(spark, folder, monkeypatch, layout, rebalances):
    found, publish = [], medallion.publish

    def watched(df, store, name, partition_by, rebalance=True):
        found.append(rebalance)
        publish(df, store, name, partition_by, rebalance)

    monkeypatch.setattr(medallion, "publish", watched)
    config = MedallionConfig(TableStore(spark, f"{folder}/silver"), TableStore(spark, f"{folder}/gold"), statistics_partitions=layout)
    rows = silver(spark)
    publish_statistics(with_bucket(rows) if len(layout) > 1 else rows, config)
    assert found == [bool(rebalances)]
    read = config.silver.read(STATISTICS)
    assert sorted((r.video_id, r.region or "", r.views, r.like_ratio) for r in read.collect()) == sorted(
        (r.video_id, r.region or "", r.views, r.like_ratio) for r in rows.collect()
    )
    assert read.count() == 150 and read.filter("region is null").count() == 50
