"""Whole runs and incremental runs."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rows import raw
from test_sources import HEADER, ITEM, category, put
from trendmark.config import CATEGORY, CHANNEL, REFERENCE, STATISTICS, TRENDING, QualityRules
from trendmark.operators.dedup import keep_latest_snapshot
from trendmark.operators.cleanse import cleanse
from trendmark.plans.medallion import MedallionConfig, QualityGateError, build_gold, run_medallion
from trendmark.plans.silver import silver_statistics, with_bucket
from trendmark.schemas import CATEGORY_ITEM, GOLD, SILVER_STATISTICS, VIDEO_ITEM
from trendmark.sources import TableStore, explode_documents
from trendmark.operators.normalize import normalize_json
from trendmark.sinks.staged import Stage
from trendmark.streaming import FirstArrivals, IncrementalMedallion, ReferenceArrivals, SnapshotUpsert, VideoArrivals, first_seen, run_available, stream_csv_snapshots, stream_documents
from trendmark.streaming import gold_refresh as refresh_module
from trendmark.streaming import upsert as upsert_module
from trendmark.workload.queries import arrivals

NOW = datetime(2024, 2, 1)


def contents(folder):
    return {str(p): p.read_bytes() for p in sorted(Path(folder).rglob("*")) if p.is_file()}


@pytest.fixture
def config(spark, folder):
    line = "v{i},17.{day:02}.11,t,c{c},{cat},p,a|b,{views},1,2,3,l,false,false,false,d\n"
    rows = [line.format(i=i, day=i % 3 + 1, c=i % 4, cat=i % 3, views=100 + i) for i in range(20)]
    put(folder, "raw/region=us/USvideos.csv", HEADER + "\n" + "".join(rows))
    put(folder, "raw/region=ca/CAvideos.csv", HEADER + "\n" + "".join(rows[:5]))
    envelope = {"fetched_at": "2024-01-31T10:00:00+00:00", "regions": {"GB": {"items": [ITEM, ITEM]}}}
    put(folder, "raw/date=2024-01-31/hour=10/a.json", envelope)
    items = [category(str(i), f"name {i}") for i in range(12)]
    put(folder, "reference/region=us/a.json", {"items": items})
    return MedallionConfig(
        TableStore(spark, folder + "/silver"),
        TableStore(spark, folder + "/gold"),
        csv_path=folder + "/raw",
        documents_path=folder + "/raw",
        categories_path=folder + "/reference",
    )


def test_full_run(spark, config):
    result = run_medallion(spark, config, NOW)
    assert result.gold_built and result.failed_checks == []
    assert result.counts["raw_rows"] == 27 and result.counts["clean_rows"] == 26
    silver = config.silver.read(STATISTICS)
    assert silver.groupBy("region").count().orderBy("region").collect() == [("ca", 5), ("gb", 1), ("us", 20)]
    assert {r.region for r in config.silver.read(REFERENCE).collect()} == {"us"}
    trending = config.gold.read(TRENDING)
    assert trending.agg(F.sum("total_videos")).first()[0] == 26
    channel = config.gold.read(CHANNEL).filter("region = 'us'").orderBy("rank_in_region").collect()
    assert [r.rank_in_region for r in channel] == [1, 2, 3, 4] and channel[0].categories[0] == "name 0"
    assert config.gold.read(CATEGORY).filter("category_name = 'name 10'").first().region == "gb"
    before = sorted(map(str, config.gold.read(CHANNEL).collect()))
    run_medallion(spark, config, NOW)
    assert sorted(map(str, config.gold.read(CHANNEL).collect())) == before


def test_failing_gate_leaves_gold_as_it_was(spark, config):
    run_medallion(spark, config, NOW)
    before = contents(config.gold.root)
    strict = MedallionConfig(**{**config.__dict__, "rules": QualityRules(min_rows=1000)})
    result = run_medallion(spark, strict, NOW)
    assert not result.gold_built and {c.check for c in result.failed_checks} == {"row_count"}
    assert contents(config.gold.root) == before
    with pytest.raises(QualityGateError, match="row_count"):
        run_medallion(spark, strict, NOW, raise_on_failure=True)


def test_upserts_continue_a_full_run(spark, config):
    daily = MedallionConfig(**{**config.__dict__, "statistics_partitions": upsert_module.DAY_PARTITIONS})
    assert run_medallion(spark, daily, NOW).gold_built
    before = config.silver.read(STATISTICS).count()
    later = {"video_id": "v0", "trending_date": "17.01.11", "views": 5000, "_arrived_at": datetime(2100, 1, 1)}
    handler = SnapshotUpsert(config.silver, config.silver.root + "-checkpoint", "job", NOW)
    handler(raw(spark, later, {"video_id": "new", "region": "jp"}), 0)
    found = spark.read.schema(SILVER_STATISTICS).parquet(config.silver.path(STATISTICS))
    assert found.count() == before + 1
    assert found.filter("video_id = 'v0' AND region = 'us'").first().views == 5000


def test_run_without_reference(spark, config):
    bare = MedallionConfig(**{**config.__dict__, "categories_path": None, "checked_tables": [STATISTICS]})
    assert run_medallion(spark, bare, NOW).gold_built
    assert {r.category_name for r in config.gold.read(CATEGORY).collect()} == {"Unknown"}


def test_run_without_sources_writes_nothing(spark, folder):
    config = MedallionConfig(TableStore(spark, folder + "/s"), TableStore(spark, folder + "/g"))
    result = run_medallion(spark, config, NOW)
    assert not result.gold_built and result.counts == {} and not config.silver.exists(STATISTICS)


def snapshots(spark):
    changes = []
    for i in range(60):
        at = datetime(2024, 1, 1 + i % 5, i % 24)
        changes.append(
            {"video_id": f"v{i % 6}", "trending_date": f"17.{i % 2 + 1:02}.11" if i % 10 else None,
             "region": ["us", " CA"][i % 3 == 0], "views": i, "_arrived_at": at}
        )
    return raw(spark, *changes)


def keyed(df):
    columns = [f.name for f in SILVER_STATISTICS.fields if f.name not in ("_processed_at", "_job_name")]
    return sorted(map(str, df.select(*columns).collect()))


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 0, 1]])
def test_batches_in_any_order_equal_one_run(spark, folder, order):
    rows = snapshots(spark)
    store = TableStore(spark, folder + "/silver")
    handler = SnapshotUpsert(store, folder + "/checkpoint", "job", NOW)
    for batch_id, part in enumerate(order):
        handler(rows.filter(F.col("views") % 3 == part), batch_id)
    found = spark.read.schema(SILVER_STATISTICS).parquet(store.path(STATISTICS))
    assert keyed(found) == keyed(keep_latest_snapshot(cleanse(rows)))


def test_a_batch_reads_its_own_days_of_five_thousand(spark, folder):
    store = TableStore(spark, folder + "/silver")
    handler = SnapshotUpsert(store, folder + "/checkpoint", "job", NOW)
    handler(raw(spark, {"trending_date": "2017-01-01"}, {"trending_date": None, "video_id": "v3"}), 0)
    table = Path(store.path(STATISTICS), "region=us")
    part = next((table / "trending_date_parsed=2017-01-01").glob("*/*.parquet"))
    for i in range(1, 5_000):
        day = table / f"trending_date_parsed={(datetime(2017, 1, 1) + timedelta(i)).date()}" / "_bucket=0"
        day.mkdir(parents=True)
        (day / part.name).write_bytes(part.read_bytes())
    fresh = [{"trending_date": f"{2017 + i % 5}-03-0{i % 4 + 1}", "views": 7, "_arrived_at": datetime(2025, 1, 1)} for i in range(20)]
    fresh += [{"trending_date": "n/a", "views": 8, "video_id": "v3", "_arrived_at": datetime(2025, 1, 1)}, {"trending_date": "2040-01-01"}]
    staged = Stage(spark, folder + "/staged", upsert_module.DAY_PARTITIONS)
    staged.write(with_bucket(silver_statistics(raw(spark, *fresh), "job", NOW)))
    rows = upsert_module.rows_of_folders(store, staged.folders())
    days = {f.split("trending_date_parsed=")[1].split("/")[0] for f in rows.inputFiles()}
    assert len(staged.folders()) == 22 and len(rows.inputFiles()) == 21  # one day is new
    assert days <= {f.split("=")[2].split("/")[0] for f in staged.folders()}
    assert {str(r.trending_date_parsed) for r in rows.collect()} == (days - {"__HIVE_DEFAULT_PARTITION__"}) | {"None"}
    untouched = contents(table / "trending_date_parsed=2020-02-01")
    handler(raw(spark, *fresh), 1)
    found = spark.read.schema(SILVER_STATISTICS).parquet(store.path(STATISTICS))
    assert found.count() == 5_000 + 2 and found.filter("views = 7").count() == 20
    assert found.filter("trending_date_parsed is null").first().views == 8
    assert contents(table / "trending_date_parsed=2020-02-01") == untouched


def test_an_undated_row_rewrites_its_bucket_only(spark, folder):
    store = TableStore(spark, folder + "/silver")
    handler = SnapshotUpsert(store, folder + "/checkpoint", "job", NOW)
    handler(raw(spark, *[{"video_id": f"v{i}", "trending_date": "n/a", "views": 1} for i in range(300)]), 0)
    undated = Path(store.path(STATISTICS), "region=us", "trending_date_parsed=__HIVE_DEFAULT_PARTITION__")
    before = {bucket.name: contents(bucket) for bucket in undated.iterdir() if bucket.is_dir()}
    handler(raw(spark, {"video_id": "v7", "trending_date": None, "views": 2, "_arrived_at": datetime(2025, 1, 1)}), 1)
    after = {bucket.name: contents(bucket) for bucket in undated.iterdir() if bucket.is_dir()}
    assert len(before) > 50 and len([name for name in before if before[name] != after[name]]) == 1
    rows = spark.read.schema(SILVER_STATISTICS).parquet(store.path(STATISTICS)).collect()
    assert len(rows) == 300 and {r.video_id for r in rows if r.views == 2} == {"v7"}


def test_batches_list_their_partitions_only(spark, folder, monkeypatch):
    store = TableStore(spark, folder + "/silver", database="lake_batches")
    handler = SnapshotUpsert(store, folder + "/checkpoint", "job", NOW)
    handler(raw(spark, {"trending_date": "17.01.11"}), 0)
    asked, real = [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: asked.append(text) or real(text, *a, **k))
    handler(raw(spark, {"trending_date": "17.02.11", "region": "o'x"}, {"trending_date": None}), 1)
    monkeypatch.undo()
    assert asked and not any("RECOVER" in text for text in asked)
    listed = spark.table("lake_batches.clean_statistics")
    assert sorted((r.region, str(r.trending_date_parsed)) for r in listed.collect()) == [
        ("o'x", "2017-11-02"), ("us", "2017-11-01"), ("us", "None")
    ]
    spark.sql("DROP DATABASE lake_batches CASCADE")


def test_untouched_days_are_not_read_or_written(spark, folder):
    store = TableStore(spark, folder + "/silver")
    handler = SnapshotUpsert(store, folder + "/checkpoint", "job", NOW)
    handler(raw(spark, {"trending_date": "17.01.11"}, {"trending_date": "17.02.11"}), 0)
    before = contents(store.path(STATISTICS) + "/region=us/trending_date_parsed=2017-11-01")
    fresh = raw(spark, {"trending_date": "17.02.11", "views": 7, "_arrived_at": datetime(2025, 1, 1)})
    handler(fresh, 1)
    assert contents(store.path(STATISTICS) + "/region=us/trending_date_parsed=2017-11-01") == before
    days = spark.read.schema(SILVER_STATISTICS).parquet(store.path(STATISTICS)).orderBy("trending_date_parsed").collect()
    assert [r.views for r in days] == [100, 7]


def test_batch_stopped_in_the_swap_is_finished_from_its_stage(spark, folder, monkeypatch):
    store = TableStore(spark, folder + "/silver")
    handler = SnapshotUpsert(store, folder + "/checkpoint", "job", NOW)
    handler(raw(spark, {"views": 1}, {"video_id": "v2"}), 0)
    later = raw(spark, {"views": 2, "_arrived_at": datetime(2025, 1, 1)})
    real = upsert_module.write_partitioned

    def stop_at_swap(df, path, *args, **kwargs):
        if path == store.path(STATISTICS):
            # Worst case: the old partition is gone and the new one is not there yet.
            Path(path, "region=us").rename(folder + "/lost")
            raise RuntimeError("executor lost")
        real(df, path, *args, **kwargs)

    monkeypatch.setattr(upsert_module, "write_partitioned", stop_at_swap)
    with pytest.raises(RuntimeError):
        handler(later, 1)
    monkeypatch.setattr(upsert_module, "write_partitioned", real)
    handler(later, 1)
    found = spark.read.schema(SILVER_STATISTICS).parquet(store.path(STATISTICS)).collect()
    assert sorted((r.video_id, r.views) for r in found) == [("v1", 2), ("v2", 100)]


def test_file_stream_reads_each_file_once(spark, folder):
    store = TableStore(spark, folder + "/silver")
    seen = []
    inner = SnapshotUpsert(store, folder + "/checkpoint", "job", NOW)

    def handler(batch, batch_id):
        seen.append(batch.count())
        inner(batch, batch_id)

    def run():
        stream = stream_documents(spark, folder + "/raw", VIDEO_ITEM, max_files=1)
        run_available(normalize_json(explode_documents(stream, VIDEO_ITEM)), handler, folder + "/checkpoint")

    def document(day, views):
        item = {**ITEM, "statistics": {"viewCount": views}}
        return {"items": [item], "_pipeline_metadata": {"region": "US", "ingestion_timestamp": f"2024-01-{day}T00:00:00Z"}}

    put(folder, "raw/b.json", document("02", 5))
    put(folder, "raw/c.json", document("03", 6))
    run()
    run()
    assert sum(seen) == 2
    late = {**document("02", 9)}
    late["_pipeline_metadata"]["ingestion_timestamp"] = "2024-01-02T05:00:00Z"
    put(folder, "raw/late.json", late)
    run()
    assert sum(seen) == 3
    found = spark.read.schema(SILVER_STATISTICS).parquet(store.path(STATISTICS))
    assert sorted((str(r.trending_date_parsed), r.views) for r in found.collect()) == [("2024-01-02", 9), ("2024-01-03", 6)]


def test_reference_stream_quarantines_bad_documents(spark, folder):
    store = TableStore(spark, folder + "/silver")
    put(folder, "raw/region=US/a.json", {"items": [category("1", "A"), category("1", "B")]})
    put(folder, "raw/region=CA/b.json", "{ not json")
    put(folder, "raw/region=GB/c.json", {"items": []})
    stream = stream_documents(spark, folder + "/raw", CATEGORY_ITEM)
    run_available(stream, ReferenceArrivals(store, folder + "/bad", NOW), folder + "/checkpoint")
    assert [(r.region, r.id, r["snippet.title"]) for r in store.read(REFERENCE).collect()] == [("us", "1", "B")]
    assert spark.read.parquet(folder + "/bad").count() == 1


def test_csv_stream_and_bounded_dedup(spark, folder):
    line = "v1,17.01.11,t,c,1,p,a,{views},1,2,3,l,false,false,false,d\n"
    put(folder, "raw/region=us/a.csv", HEADER + "\n" + line.format(views=1) + line.format(views=2))
    put(folder, "raw/region=ca/b.CSV", HEADER + "\n" + line.format(views=3))
    from trendmark.operators.normalize import normalize_csv

    stream = first_seen(cleanse(normalize_csv(stream_csv_snapshots(spark, folder + "/raw"))))
    query = stream.writeStream.format("parquet").option("path", folder + "/out")
    query.option("checkpointLocation", folder + "/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.region for r in spark.read.parquet(folder + "/out").collect()) == ["ca", "us"]


def test_older_reference_document_in_a_later_batch_is_ignored(spark, folder):
    store = TableStore(spark, folder + "/silver")
    document = lambda day, name: {"fetched_at": f"2024-01-{day}T00:00:00+00:00", "items": [category("1", name)]}
    for day, name in [("05", "new"), ("01", "old")]:
        put(folder, f"raw/region=US/{name}.json", document(day, name))
        stream = stream_documents(spark, folder + "/raw", CATEGORY_ITEM)
        run_available(stream, ReferenceArrivals(store, folder + "/bad", NOW), folder + "/checkpoint")
    assert [r["snippet.title"] for r in store.read(REFERENCE).collect()] == ["new"]


def test_unreadable_statistics_documents_are_kept_and_counted(spark, config, folder):
    put(folder, "raw/region=us/broken.json", "{ not json")
    result = run_medallion(spark, config, NOW)
    assert result.counts["corrupt_documents"] == 1 and result.counts["raw_rows"] == 27
    assert spark.read.parquet(folder + "/silver/quarantined_documents").count() == 1


def gold_rows(spark, store):
    """Rows of the three Gold tables, averages to ten digits."""
    out = {}
    for name in (TRENDING, CHANNEL, CATEGORY):
        rows = spark.read.schema(GOLD[name]).parquet(store.path(name))
        doubles = {c: F.round(c, 10) for c, kind in rows.dtypes if kind == "double"}
        out[name] = sorted(map(str, rows.withColumns(doubles).collect()))
    return out


def gold_waves(spark):
    """Rows of three waves: the later ones touch few days, move a video to another channel and bring a new region."""
    base = [
        {"video_id": f"v{i % 9}", "trending_date": f"17.{i % 4 + 1:02}.11" if i % 11 else None, "channel_title": f"c{i % 5}" if i % 13 else None,
         "region": ["us", "ca"][i % 2], "category_id": i % 3, "views": i, "_arrived_at": datetime(2024, 1, 1, i % 24)} for i in range(80)
    ]
    later = {"_arrived_at": datetime(2024, 2, 1)}
    return [
        base,
        [{"video_id": "v0", "trending_date": "17.01.11", "channel_title": "c9", "views": 900, **later}, {"video_id": "new", "region": "jp", **later}],
        [{"video_id": "v1", "trending_date": None, "channel_title": None, "views": 5, **later}, {"video_id": "v2", "trending_date": "17.09.11", "views": 7, **later}],
    ]


def test_incremental_gold_equals_a_full_rebuild(spark, folder):
    rules, seen = QualityRules(min_rows=1, max_null_pct=100.0), []
    silver, gold = TableStore(spark, folder + "/silver"), TableStore(spark, folder + "/gold", database="gold_inc")
    handler = IncrementalMedallion(silver, gold, folder + "/checkpoint", "job", rules, NOW)
    for batch_id, wave in enumerate(gold_waves(spark)):
        handler(raw(spark, *wave), batch_id)
        assert handler.verdict.quality_passed
        whole = MedallionConfig(silver, TableStore(spark, f"{folder}/full-{batch_id}"))
        build_gold(whole, NOW)
        assert gold_rows(spark, gold) == gold_rows(spark, whole.gold)
        seen += [gold_rows(spark, gold)]
    assert seen[0] != seen[1] != seen[2]
    assert spark.table("gold_inc.channel_analytics").count() == len(seen[2][CHANNEL])
    spark.sql("DROP DATABASE gold_inc CASCADE")


def test_gold_refresh_reads_touched_days_only(spark, folder, monkeypatch):
    rules = QualityRules(min_rows=1, max_null_pct=100.0)
    silver, gold = TableStore(spark, folder + "/silver"), TableStore(spark, folder + "/gold")
    handler = IncrementalMedallion(silver, gold, folder + "/checkpoint", "job", rules, NOW)
    waves = gold_waves(spark)
    handler(raw(spark, *waves[0]), 0)
    handler.upsert(raw(spark, *waves[1]), 1)
    touched, folders = handler.upsert.touched(spark, handler.upsert.pending(spark))
    assert folders == ["region=jp/trending_date_parsed=2017-11-14", "region=us/trending_date_parsed=2017-11-01"]
    days = refresh_module.read_folders(spark, silver.path(STATISTICS), folders, SILVER_STATISTICS)
    assert {f.split("clean_statistics/")[1].split("/_bucket")[0] for f in days.inputFiles()} == set(folders)
    # c9 comes, and the channel that had v0 before goes; no other is counted again.
    before = {r.channel_title for r in touched.filter("region = 'us'").collect()}
    assert "c9" in before and len(before) == 2
    untouched = contents(gold.path(TRENDING) + "/region=ca")
    handler.refresh()
    assert contents(gold.path(TRENDING) + "/region=ca") == untouched and handler.upsert.pending(spark) == []


def test_gold_waits_for_rows_that_pass_and_goes_on_after_a_stop(spark, folder, monkeypatch):
    silver, gold = TableStore(spark, folder + "/silver"), TableStore(spark, folder + "/gold")
    strict = IncrementalMedallion(silver, gold, folder + "/checkpoint", "job", QualityRules(min_rows=1000), NOW)
    waves = gold_waves(spark)
    strict(raw(spark, *waves[0]), 0)
    assert not strict.verdict.quality_passed and not gold.exists(TRENDING) and strict.upsert.pending(spark) == ["0"]
    handler = IncrementalMedallion(silver, gold, folder + "/checkpoint", "job", QualityRules(min_rows=1, max_null_pct=100.0), NOW)
    real, written = refresh_module.write_partitioned, []

    def stop_at_second(df, path, *args, **kwargs):
        written.append(path)
        if len(written) == 2:
            raise RuntimeError("executor lost")
        real(df, path, *args, **kwargs)

    monkeypatch.setattr(refresh_module, "write_partitioned", stop_at_second)
    with pytest.raises(RuntimeError):
        handler(raw(spark, *waves[1]), 1)
    monkeypatch.setattr(refresh_module, "write_partitioned", real)
    handler(raw(spark, *waves[1]), 1)
    whole = MedallionConfig(silver, TableStore(spark, folder + "/full"))
    build_gold(whole, NOW)
    assert gold_rows(spark, gold) == gold_rows(spark, whole.gold) and handler.upsert.pending(spark) == []


def test_unreadable_video_documents_of_a_stream_are_kept(spark, folder):
    store = TableStore(spark, folder + "/silver")
    handler = VideoArrivals(SnapshotUpsert(store, folder + "/checkpoint", "job", NOW), folder + "/bad")
    document = {"items": [ITEM], "_pipeline_metadata": {"region": "US", "ingestion_timestamp": "2024-01-02T00:00:00Z"}}

    def run():
        stream = stream_documents(spark, folder + "/raw", VIDEO_ITEM, max_files=2)
        run_available(stream, handler, folder + "/checkpoint")

    put(folder, "raw/a.json", document)
    put(folder, "raw/b.json", "{ not json")
    run()
    put(folder, "raw/c.json", '{"items": [')
    run()
    assert spark.read.parquet(store.path(STATISTICS)).count() == 1
    bad = spark.read.parquet(folder + "/bad").orderBy("_source_file").collect()
    assert [Path(r._source_file).name for r in bad] == ["b.json", "c.json"] and bad[0]._corrupt_record == "{ not json"


def test_late_first_arrivals_are_kept_apart(spark, folder):
    handler = FirstArrivals(folder + "/first", "24 hours")

    def wave(*arrivals):
        rows = [{"video_id": v, "trending_date": d, "_arrived_at": datetime(2024, 1, day, hour)} for v, d, day, hour in arrivals]
        return cleanse(raw(spark, *rows))

    waves = [
        wave(("a", "17.01.11", 10, 5), ("a", "17.01.11", 10, 2), ("b", None, 9, 1), ("old", "17.01.11", 1, 0)),  # nothing is late yet
        wave(("a", "17.01.11", 10, 6), ("c", "17.01.11", 9, 4), ("d", "17.02.11", 9, 5), ("b", None, 8, 0)),  # c is, b and a are repeats
        wave(("c", "17.01.11", 12, 0), ("e", "17.03.11", 9, 6), ("f", None, 9, 4)),  # the limit has not moved
        wave(("g", "17.01.11", 10, 23), ("f", None, 13, 0)),
    ]
    for batch_id, rows in enumerate(waves):
        handler(rows, batch_id)
    handler(waves[3], 3)  # a batch may come again
    found = {late: sorted((r.video_id, r._arrived_at.day, r._arrived_at.hour) for r in handler.read(spark, late).collect()) for late in (False, True)}
    assert found[False] == [("a", 10, 2), ("b", 9, 1), ("d", 9, 5), ("e", 9, 6), ("old", 1, 0)]
    assert found[True] == [("c", 9, 4), ("f", 9, 4), ("g", 10, 23)]


def test_category_documents_that_break_rules_are_refused_and_reported(spark, config, folder):
    put(folder, "reference/region=fr/broken.json", "{ not json")
    put(folder, "reference/region=de/empty.json", {"items": []})
    result = run_medallion(spark, config, NOW)
    found = {r.column: r.value for r in result.category_checks}
    assert result.gold_built and found == {"unreadable": 1, "no_items": 1, "no_id": 0, "no_title": 0, "repeated_id": 0}
    assert spark.read.parquet(folder + "/silver/quarantined_categories").count() == 2


def test_unreadable_documents_are_told_without_keeping_the_batch(spark, folder):
    kept, seen = [], []

    def rows(df, batch_id):
        kept.append(spark.sparkContext._jsc.getPersistentRDDs().size() - before)
        seen.extend(r.video_id for r in df.select("video_id").collect())

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    put(folder, "raw/a.json", {"items": [ITEM]})
    put(folder, "raw/b.json", {"items": [ITEM], "etag": "x", "snippet": "not a structure"})  # a field no row needs
    stream = stream_documents(spark, folder + "/raw", VIDEO_ITEM)
    run_available(stream, VideoArrivals(rows, folder + "/bad"), folder + "/checkpoint")
    bad = spark.read.parquet(folder + "/bad").collect()
    assert [Path(r._source_file).name for r in bad] == ["b.json"] and len(seen) == 1 and set(kept) == {0}


def test_a_batch_is_shuffled_by_its_merge_alone(spark, folder):
    store = TableStore(spark, folder + "/silver")
    handler = SnapshotUpsert(store, folder + "/checkpoint", "job", NOW)
    batch = raw(spark, {"views": 1}, {"views": 3, "_arrived_at": datetime(2025, 1, 2)}, {"views": 2, "_arrived_at": datetime(2025, 1, 1)})
    for batch_id in (0, 1, 1):
        handler(batch, batch_id)
    assert [r.views for r in spark.read.schema(SILVER_STATISTICS).parquet(store.path(STATISTICS)).collect()] == [3]
    staged = handler._stage(spark, "fresh", 1).read(upsert_module.SILVER_BY_DAY)
    assert sorted(r.views for r in staged.collect()) == [1, 2, 3]  # as they came


def test_a_wave_parses_its_own_documents(spark, tiny):
    plan = arrivals(spark, tiny, F.hour("_arrived_at") <= 2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("from_json(") < plan.index("hour(")  # filtered below the parse
    assert plan.count("hour(") == 1
