from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rows import raw
from trendmark.functions import clean_region, file_stem, path_value, region_code, url_decoded
from trendmark.operators.cleanse import cleanse, with_audit
from trendmark.operators.dedup import keep_latest_snapshot
from trendmark.plans.silver import silver_statistics, stage_row_counts


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("17.14.11", date(2017, 11, 14)),
        ("2026-07-14", date(2026, 7, 14)),
        ("2026-07-14T10:00:00Z", date(2026, 7, 14)),
        ("17.32.13", None),
        ("x", None),
        ("7.14.11", None),
        (None, None),
    ],
)
def test_trending_date(spark, text, expected):
    assert cleanse(raw(spark, {"trending_date": text})).first().trending_date_parsed == expected


def test_cleanse_settles_region_key_and_counters(spark):
    rows = cleanse(raw(spark, {"region": " US "}, {"video_id": None}, {"views": None, "likes": None})).collect()
    assert len(rows) == 2
    assert {row.region for row in rows} == {"us"}
    assert rows[1].views == 0 and rows[1].likes == 0 and rows[1].like_ratio == 0.0


@pytest.mark.parametrize(
    ("views", "likes", "ratio"), [(3, 1, 33.3333), (0, 5, 0.0), (-5, 5, 0.0), (100, 10, 10.0), (None, 3, 0.0)]
)
def test_like_ratio(spark, views, likes, ratio):
    assert cleanse(raw(spark, {"views": views, "likes": likes})).first().like_ratio == ratio


def test_engagement_rate_counts_all_reactions(spark):
    assert cleanse(raw(spark, {})).first().engagement_rate == 13.0
    huge = {"views": 2**62, "likes": 2**62, "dislikes": 2**62, "comment_count": 2**62}
    assert cleanse(raw(spark, huge)).first().engagement_rate == 300.0


def test_later_arrival_stays_whatever_its_counters(spark):
    rows = raw(spark, {"views": 999}, {"views": 1, "_arrived_at": datetime(2024, 1, 2)})
    kept = keep_latest_snapshot(cleanse(rows)).collect()
    assert [row.views for row in kept] == [1]


def test_same_arrival_keeps_higher_counters(spark):
    kept = keep_latest_snapshot(cleanse(raw(spark, {"views": 5}, {"views": 7}, {"views": 6}))).collect()
    assert [row.views for row in kept] == [7]


def test_rows_without_date_count_as_one_day(spark):
    kept = keep_latest_snapshot(cleanse(raw(spark, {"trending_date": "x"}, {"trending_date": "y"})))
    assert kept.count() == 1


def test_dedup_is_idempotent_and_unique(spark):
    changes = [{"video_id": f"v{i % 7}", "views": i, "region": ["us", "CA "][i % 2]} for i in range(60)]
    once = silver_statistics(raw(spark, *changes), "job", datetime(2024, 2, 1))
    again = keep_latest_snapshot(once)
    assert once.count() == once.select("video_id", "region", "trending_date_parsed").distinct().count() == 14
    assert sorted(map(str, once.collect())) == sorted(map(str, again.select(once.columns).collect()))


def test_a_hot_key_sends_one_row_per_task(spark):
    """The plan limits each task's share of a key before the shuffle."""
    plan = keep_latest_snapshot(cleanse(raw(spark, {}, {}, {})))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
    assert plan.count("Exchange hashpartitioning") == 1


def test_stage_row_counts(spark):
    counts = stage_row_counts(raw(spark, {}, {}, {"video_id": None}, {"video_id": "v2"}))
    assert {row.stage: row.rows for row in counts.collect()} == {"read": 4, "cleansed": 3, "deduplicated": 2}
    empty = stage_row_counts(raw(spark, {}).filter(F.lit(False)))
    assert {row.stage: row.rows for row in empty.collect()} == {"read": 0, "cleansed": 0, "deduplicated": 0}


def test_audit_columns(spark):
    row = with_audit(raw(spark, {}), "_processed_at", datetime(2024, 2, 1), _job_name="j").first()
    assert (row._processed_at, row._job_name) == (datetime(2024, 2, 1), "j")
    text = with_audit(raw(spark, {}), "_at", datetime(2024, 2, 1), as_text=True).first()._at
    assert text.startswith("2024-02-01T00:00:00")


def test_text_helpers(spark):
    row = spark.range(1).select(
        clean_region(F.lit(" US ")).alias("a"),
        region_code(F.lit(" us ")).alias("b"),
        path_value(F.lit("x/region=US/date=2026-07-14/f.json"), "region").alias("c"),
        path_value(F.lit("a/b.json"), "region").alias("d"),
        path_value(F.lit("a/myregion=US/b.json"), "region").alias("e"),
        url_decoded(F.lit("region%3DUS/a+b.json")).alias("f"),
        url_decoded(F.lit("broken%zz")).alias("g"),
        file_stem(F.lit("s3a://bucket/x/USvideos.old.csv")).alias("h"),
        file_stem(F.lit("x/noextension")).alias("i"),
    ).first()
    assert tuple(row) == (
        "us", "US", "US", "unknown", "unknown", "region=US/a b.json", "broken%zz", "USvideos.old", "noextension"
    )
