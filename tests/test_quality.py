from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rows import raw
from trendmark.config import REFERENCE, STATISTICS, QualityRules
from trendmark.operators.quality import (
    TableChecks,
    failures,
    inline_negative_views,
    inline_null_counts,
    run_checks,
    verdict,
)
from trendmark.schemas import CHECK_ROW

NOW = datetime(2024, 2, 1)


def checks_of(df, table=STATISTICS, rules=None):
    return TableChecks(df, table, rules or QualityRules(), NOW)


def passed(spark, df, kind, table=STATISTICS, rules=None):
    rows = checks_of(df, table, rules).all().filter(F.col("check") == kind).collect()
    assert rows
    return all(row.passed for row in rows)


def many(spark, n, *changes):
    return raw(spark, *[*changes, *[{} for _ in range(n - len(changes))]])


@pytest.mark.parametrize(("rows", "ok"), [(9, False), (10, True)])
def test_row_count(spark, rows, ok):
    assert passed(spark, many(spark, rows), "row_count") is ok


@pytest.mark.parametrize(("nulls", "ok"), [(50, True), (51, False)])
def test_null_share_limit_is_inclusive(spark, nulls, ok):
    assert passed(spark, many(spark, 1000, *[{"title": None}] * nulls), "null_pct") is ok


def test_not_a_number_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"), "us")] * 20, "id double, region string")
    assert not passed(spark, df, "null_pct", REFERENCE)


def test_missing_column_fails_twice(spark):
    rows = failures(checks_of(many(spark, 10).drop("title")).all()).collect()
    assert {(r.check, r.column) for r in rows} == {("null_pct", "title"), ("schema", None)}
    assert [r.missing_columns for r in rows if r.check == "schema"] == [["title"]]


@pytest.mark.parametrize(
    ("views", "ok"), [(50_000_000_000, True), (50_000_000_001, False), (-1, False), (0, True)]
)
def test_value_range(spark, views, ok):
    assert passed(spark, many(spark, 10, {"views": views}), "value_range") is ok


def test_value_range_needs_the_column_and_the_table(spark):
    assert checks_of(many(spark, 10).drop("views")).value_ranges() == []
    assert checks_of(many(spark, 10), REFERENCE).value_ranges() == []


@pytest.mark.parametrize(("age", "ok"), [(timedelta(hours=48), True), (timedelta(hours=48, seconds=1), False)])
def test_freshness_limit_is_inclusive(spark, age, ok):
    df = many(spark, 10).withColumn("_processed_at", F.lit(NOW - age))
    assert passed(spark, df, "freshness") is ok


def test_freshness_special_cases(spark):
    df = many(spark, 10)
    assert passed(spark, df, "freshness")
    assert passed(spark, df.withColumn("_ingestion_timestamp", F.lit("soon")), "freshness")
    assert passed(spark, df.withColumn("_ingestion_timestamp", F.lit("2024-01-31T10:00:00+00:00")), "freshness")
    assert not passed(spark, df.withColumn("_ingestion_timestamp", F.lit(None).cast("string")), "freshness")
    both = df.withColumn("_ingestion_timestamp", F.lit("2024-01-31")).withColumn("_processed_at", F.lit("2020-01-01"))
    assert not passed(spark, both, "freshness")


def test_empty_table(spark):
    empty = many(spark, 10).filter(F.lit(False))
    rows = {r.check: r for r in checks_of(empty).all().collect() if r.check != "null_pct"}
    assert not rows["row_count"].passed and rows["schema"].passed and rows["value_range"].passed
    shares = checks_of(empty).all().filter("check = 'null_pct'").collect()
    assert all(r.passed and r.value == 0.0 for r in shares)


def test_unknown_table_fails(spark):
    rows = checks_of(many(spark, 10), "clean_stats").all()
    assert {r.check for r in failures(rows).collect()} == {"schema"}


def test_unreadable_table_does_not_stop_the_others(spark, folder):
    readers = {REFERENCE: lambda: spark.read.parquet(folder + "/none"), STATISTICS: lambda: many(spark, 10)}
    checks = run_checks(spark, readers, as_of=NOW)
    assert checks.schema.fieldNames() == CHECK_ROW.fieldNames()
    found = verdict(checks).first()
    assert not found.quality_passed and found.checks_total - found.checks_passed == 1
    assert [d.check for d in found.details if not d.passed] == ["read_table"]
    assert found.checks_total == 1 + 9


def test_nothing_to_check_passes(spark):
    assert verdict(run_checks(spark, {}, as_of=NOW)).first().quality_passed


def test_one_pass_over_the_table(spark):
    plan = checks_of(many(spark, 10)).all()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and plan.count("Aggregate") == 1


def test_sampling_is_off_unless_asked_for(spark):
    readers = {STATISTICS: lambda: many(spark, 30)}
    count = lambda rules: run_checks(spark, readers, rules, NOW).filter("check = 'row_count'").first().value
    assert count(QualityRules()) == 30 and count(QualityRules(sample_rows=12)) == 12


def test_inline_counts(spark):
    df = raw(spark, {"title": None, "views": None}, {"views": -3}, {})
    assert {r.column_name: r.null_count for r in inline_null_counts(df).collect()} == {
        "video_id": 0, "title": 1, "channel_title": 0, "views": 1
    }
    assert inline_negative_views(df).first().negative_views == 1


def test_broken_file_of_one_table_does_not_stop_the_others(spark, folder):
    spark.range(3).write.parquet(folder + "/broken")
    for part in Path(folder, "broken").glob("*.parquet"):
        part.write_bytes(b"no parquet")
    readers = {
        "broken": lambda: spark.read.schema("id bigint").parquet(folder + "/broken"),
        "whole": lambda: spark.range(3),
    }
    rows = run_checks(spark, readers, as_of=NOW).collect()
    assert [(r.check, r.passed) for r in rows if r.table == "broken"] == [("read_table", False)]
    assert [r.value for r in rows if r.table == "whole" and r.check == "row_count"] == [3]
