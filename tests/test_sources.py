import json
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rows import raw
from trendmark.functions import field_or, flatten_struct
from trendmark.operators.normalize import normalize_csv, normalize_json, union_sources
from trendmark.operators.validation import category_checks, judged_categories, quarantined_categories
from trendmark.operators.reference import category_items, keep_last_category, refine_reference
from trendmark.schemas import CATEGORY_ITEM, SNAPSHOT_COLUMNS, VIDEO_ITEM
from trendmark.sinks import convert_csv, publish, write_partitioned, write_raw_documents
from trendmark.sources import (
    TableStore,
    explode_documents,
    parse_documents,
    read_csv_inferred,
    read_csv_snapshots,
    read_documents,
    split_corrupt,
    with_columns_of,
)
from trendmark.sources.csv_headers import header_lines
from trendmark.sources.csv_snapshots import in_regions
from trendmark.streaming import stream_csv_snapshots
from trendmark.workload import snapshot as snapshot_module
from trendmark.workload.queries import write_drifting_csv
from trendmark.workload.snapshot import by_part

ITEM = {
    "id": "abc",
    "snippet": {
        "title": "T",
        "channelTitle": "C",
        "categoryId": "10",
        "publishedAt": "2026-07-01T00:00:00Z",
        "tags": ["x", "y"],
        "description": "line\nbreak",
        "thumbnails": {"default": {"url": "https://img.example/abc.jpg"}},
    },
    "statistics": {"viewCount": "1000", "likeCount": 50, "commentCount": "7"},
}
HEADER = ",".join(name for name in SNAPSHOT_COLUMNS if name != "region")


def put(folder, name, content, pretty=True):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content, indent=2 if pretty else None))
    return str(path)


def test_csv_snapshots_keep_quoted_line_breaks_and_bad_cells(spark, folder):
    row = 'v1,17.14.11,"a ""quoted"", title",c,10,p,t,{views},1,2,3,l,false,true,False,"two\nlines"\n'
    put(folder, "region=us/USvideos.csv", HEADER + "\n" + row.format(views="12") + row.format(views="many"))
    put(folder, "region=CA/CAvideos.CSV", HEADER + "\n" + row.format(views="13"))
    put(folder, "region=us/date=2026-07-14/x.json", {"items": []})
    rows = normalize_csv(read_csv_snapshots(spark, folder)).orderBy("region", "views").collect()
    assert [(r.region, r.views) for r in rows] == [("CA", 13), ("us", None), ("us", 12)]
    assert rows[0].title == 'a "quoted", title' and rows[0].description == "two\nlines"
    assert rows[0].ratings_disabled is True and rows[0].video_error_or_removed is False
    assert rows[0]._arrived_at is not None
    only = read_csv_snapshots(spark, folder, regions=["ca"])
    assert {r.region for r in only.collect()} == {"CA"}
    leaves = only._jdf.queryExecution().executedPlan().executedPlan().collectLeaves().head().plan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size()) if leaves.apply(i).metrics().contains("numFiles")]
    assert [scan.metrics().get("numFiles").get().value() for scan in scans] == [1]


def drifting_files(folder):
    """The canonical layout, columns in reverse, one missing and one added, capitals; a header alone, an empty file."""
    names = HEADER.split(",")
    cells = dict(zip(names, ["v1", "17.14.11", '"t, ""x""\nline"', "c", "10", "p", "a|b", "12", "1", "2", "3", "l", "false", "true", "False", "d"]))
    layouts = {
        "a": names,
        "b": names[::-1],
        "c": ["added", *[n for n in names if n not in ("likes", "title")]],
        "d": [f'" {n.upper()} "' for n in sorted(names)],
    }
    for name, columns in layouts.items():
        row = ",".join(cells.get(c.strip('" ').lower(), '"more, cells"') for c in columns)
        put(folder, f"region={name}/{name}.csv", ("\ufeff" if name == "b" else "") + ",".join(columns) + "\n" + f"{row}\n" * 2)
    put(folder, "region=e/e.csv", HEADER + "\n")
    put(folder, "region=e/f.csv", "")
    put(folder, "region=e/g.csv", "\n\n" + HEADER + "\n" + ",".join(cells[n].replace("\n", " ") for n in names) + "\n")


def drift_checked(rows):
    found = {r.region: r for r in rows}
    assert [r.region for r in rows] == ["a", "a", "b", "b", "c", "c", "d", "d", "e"]
    for region, r in found.items():
        assert (r.video_id, r.views, r.dislikes, r.description, r.ratings_disabled) == ("v1", 12, 2, "d", True)
        assert (r.likes, r.title is None) == ((None, True) if region == "c" else (1, False))
    assert found["b"].title == 't, "x"\nline' and "added" not in rows[0]


def test_csv_columns_are_found_by_name(spark, folder):
    drifting_files(folder)
    drift_checked(normalize_csv(read_csv_snapshots(spark, folder)).orderBy("region").collect())
    only = normalize_csv(read_csv_snapshots(spark, folder, ["c"], multi_line=False))
    assert {r.views for r in only.collect()} == {12}


def test_streamed_csv_columns_are_found_by_name(spark, folder):
    drifting_files(folder + "/raw")

    def landed(name, **options):
        stream = normalize_csv(stream_csv_snapshots(spark, folder + "/raw", **options))
        query = stream.writeStream.format("parquet").option("path", f"{folder}/{name}")
        query.option("checkpointLocation", f"{folder}/{name}-checkpoint").trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(f"{folder}/{name}").orderBy("region").collect()

    drift_checked(landed("all"))
    drift_checked(landed("by_three", max_files=3))
    with pytest.raises(StreamingQueryException, match="more than 10 columns"):
        landed("narrow", width=10)


def test_headers_are_read_without_the_files(spark, folder):
    for i in range(3):
        put(folder, f"in/f{i}.csv", "id,n\n" + "1,2\n" * 2_000_000)
    started = time.perf_counter()
    assert {r.header for r in header_lines(spark, folder + "/in").collect()} == {"id,n"}
    first = time.perf_counter() - started
    started = time.perf_counter()
    assert spark.read.text(folder + "/in").filter("value = 'x'").count() == 0
    assert first < 20 * (time.perf_counter() - started)


def test_csv_without_region_folder(spark, folder):
    put(folder, "a.csv", HEADER + "\n" + ",".join(["v1"] * 16) + "\n")
    assert read_csv_snapshots(spark, folder).first().region == "unknown"


def test_single_region_and_envelope_documents(spark, folder):
    put(folder, "region=us/date=2026-07-14/hour=10/a.json", {"kind": "k", "items": [ITEM, {**ITEM, "id": "def"}]})
    envelope = {
        "ingestion_id": "20260714_100000",
        "fetched_at": "2026-07-14T10:00:00+00:00",
        "regions": {"GB": {"items": [ITEM]}, "IN": {"items": []}, "JP": {}},
    }
    put(folder, "date=2026-07-14/hour=10/b.json", envelope)
    put(folder, "date=2026-07-14/hour=10/c.json", "{ broken")
    good, bad = split_corrupt(read_documents(spark, folder, VIDEO_ITEM))
    rows = explode_documents(good, VIDEO_ITEM).orderBy("region", "id").collect()
    assert [(r.region, r.id, r._position) for r in rows] == [("GB", "abc", 0), ("us", "abc", 0), ("us", "def", 1)]
    assert rows[0]._arrived_at == datetime(2026, 7, 14, 10)
    assert [Path(r._source_file).name for r in bad.collect()] == ["c.json"]


def test_documents_in_lines_equal_documents_in_files(spark, folder):
    put(folder, "pretty/region=us/a.json", {"items": [ITEM]})
    put(folder, "lines/region=us/a.json", json.dumps({"items": [ITEM]}) + "\n" + json.dumps({"items": [ITEM]}))
    pretty = explode_documents(read_documents(spark, f"{folder}/pretty", VIDEO_ITEM), VIDEO_ITEM)
    lines = explode_documents(read_documents(spark, f"{folder}/lines", VIDEO_ITEM, multi_line=False), VIDEO_ITEM)
    assert pretty.select("id", "snippet").collect() * 2 == lines.select("id", "snippet").collect()


def test_normalize_json_nested_and_flat_agree(spark):
    text = json.dumps({"items": [ITEM], "_pipeline_metadata": {"region": "US", "ingestion_timestamp": "2026-07-14T10:00:00Z"}})
    documents = parse_documents(spark.createDataFrame([(text,)], "value string"), VIDEO_ITEM)
    nested = explode_documents(documents, VIDEO_ITEM)
    row = normalize_json(nested).first()
    assert (row.video_id, row.trending_date, row.region, row.category_id) == ("abc", "26.14.07", "US", 10)
    assert (row.views, row.likes, row.dislikes, row.comment_count) == (1000, 50, None, 7)
    assert row.tags == "x|y" and row.comments_disabled is False
    for separator in (".", "__", "_"):
        flat = normalize_json(flatten_struct(nested, separator)).first()
        assert flat == row


def test_normalize_json_without_optional_fields(spark):
    bare = spark.createDataFrame([("abc", "us")], "id string, region string")
    row = normalize_json(bare).first()
    assert row.dislikes == 0 and row.tags is None and row.thumbnail_link is None and row.views is None


def test_union_of_empty_sides(spark):
    rows = normalize_csv(raw(spark, {}, {}))
    empty = rows.filter(F.lit(False))
    assert union_sources(rows, empty).count() == union_sources(empty, rows).count() == 2
    assert union_sources(empty, empty).count() == 0
    assert union_sources(empty, empty).columns == rows.columns


def test_field_or_default_and_bad_values(spark):
    df = spark.createDataFrame([("x",)], "n string")
    row = df.select(field_or(df, "n", "bigint").alias("a"), field_or(df, "no.such", "bigint", 0).alias("b")).first()
    assert (row.a, row.b) == (None, 0)


def categories(spark, *documents):
    rows = [(json.dumps(text), key, datetime(2024, 1, day)) for text, key, day in documents]
    texts = spark.createDataFrame(rows, "value string, key string, at timestamp")
    return parse_documents(texts, CATEGORY_ITEM, "value", F.col("key"), F.col("at"))


def category(id_, title):
    return {"id": id_, "snippet": {"title": title}}


def test_category_documents(spark):
    documents = categories(
        spark,
        ({"kind": "k", "etag": "e", "items": [category("10", "A"), category("1", "F"), category("10", "B")]}, "ref/region%3DUS/a.json", 1),
        (category("7", "alone"), "ref/b.json", 1),
        ({"items": []}, "ref/region=CA/c.json", 1),
        ({"regions": {"GB": {"items": [category("2", "G")]}}}, "ref/date=2026-07-14/d.json", 1),
    )
    rows = keep_last_category(category_items(documents)).orderBy("region", "id").collect()
    found = [(r.region, r.id, r["snippet.title"]) for r in rows]
    assert found == [("GB", "2", "G"), ("US", "1", "F"), ("US", "10", "B"), ("unknown", "7", "alone")]


def test_newest_category_document_replaces_its_region(spark):
    documents = categories(
        spark,
        ({"items": [category("1", "old"), category("2", "gone")]}, "ref/region=US/a.json", 1),
        ({"items": [category("1", "new")]}, "ref/region=us/b.json", 2),
    )
    rows = refine_reference(documents).collect()
    assert [(r.region, r.id, r["snippet.title"]) for r in rows] == [("us", "1", "new")]


def test_dynamic_overwrite_leaves_other_partitions(spark, folder):
    rows = raw(spark, {"region": "us"}, {"region": "ca"}, {"region": None})
    write_partitioned(rows, folder + "/t")
    before = {p: p.stat().st_mtime_ns for p in Path(folder, "t", "region=ca").iterdir()}
    write_partitioned(raw(spark, {"region": "us", "views": 7}), folder + "/t")
    found = spark.read.parquet(folder + "/t").collect()
    assert sorted((str(r.region), r.views) for r in found) == [("None", 100), ("ca", 100), ("us", 7)]
    assert before == {p: p.stat().st_mtime_ns for p in Path(folder, "t", "region=ca").iterdir()}


def test_a_busy_region_is_written_by_many_tasks(spark, folder):
    rows = spark.range(0, 300_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("video_id"),
        F.when(F.col("id") % 100 == 0, "ca").otherwise("us").alias("region"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "2m")
    try:
        write_partitioned(rows, folder + "/t")
    finally:
        spark.conf.set(size, before)
    files = {region: len(list(Path(folder, "t", f"region={region}").glob("*.parquet"))) for region in ("us", "ca")}
    assert files["us"] > 3 and files["ca"] == 1
    assert spark.read.parquet(folder + "/t").count() == 300_000


def test_catalog_table_gains_partitions_and_columns(spark, folder):
    store = TableStore(spark, folder, database="layer_test")
    publish(raw(spark, {"region": "us"}).select("video_id", "region"), store, "t")
    publish(raw(spark, {"region": "ca"}).select("video_id", "views", "region"), store, "t")
    rows = spark.table("layer_test.t").orderBy("region").collect()
    assert [(r.region, r.views) for r in rows] == [("ca", 100), ("us", None)]
    spark.sql("DROP DATABASE layer_test CASCADE")


def test_schema_evolution(spark, folder):
    store = TableStore(spark, folder)
    assert store.read_if_present("t") is None
    old, new = raw(spark, {"region": "us"}).drop("likes"), raw(spark, {"region": "ca"})
    write_partitioned(old, store.path("t"))
    write_partitioned(new, store.path("t"))
    merged = store.read("t", merge_schema=True)
    assert {(r.region, r.likes) for r in merged.collect()} == {("us", None), ("ca", 10)}
    widened = with_columns_of(old, new.schema)
    assert widened.columns == new.columns and widened.first().likes is None


def test_raw_documents_keep_unknown_fields_and_replace_their_fetch(spark, folder):
    texts = spark.createDataFrame(
        [('{"items": [], "extra": 1}', datetime(2026, 7, 14, 10, 5)), ('{"items": []}', datetime(2026, 7, 14, 11, 0))],
        "doc string, at timestamp",
    )
    for _ in range(2):
        write_raw_documents(texts, "doc", F.col("at"), folder + "/raw")
    found = spark.read.text(folder + "/raw")
    assert {(str(r.date), r.hour, r.value) for r in found.collect()} == {
        ("2026-07-14", 10, '{"items": [], "extra": 1}'),
        ("2026-07-14", 11, '{"items": []}'),
    }
    assert found.count() == 2
    assert read_documents(spark, folder + "/raw", VIDEO_ITEM, multi_line=False).count() == 2
    write_raw_documents(texts, "doc", F.col("at"), folder + "/daily", by_hour=False)
    assert "hour" not in spark.read.text(folder + "/daily").columns


def test_convert_csv_by_layout(spark, folder):
    put(folder, "in/USvideos.csv", "id,n\n1,2\n3,4\n")
    put(folder, "in/deep/b.CSV", "name;x\nq;1\n".replace(";", ","))
    put(folder, "in/x/same.csv", "id,n\n5,6\n")
    put(folder, "in/y/same.csv", "id,n\n7,8\n9,10,11\n")
    put(folder, "in/empty.csv", "")
    put(folder, "in/note.txt", "id,n\n0,0\n")
    manifest = convert_csv(spark, folder + "/in", folder + "/out").collect()
    by_file = {"/".join(Path(r.source).parts[-2:]): (r.dest, r.rows) for r in manifest}
    assert by_file["in/USvideos.csv"] == ("USvideos", 2) and by_file["deep/b.CSV"] == ("b", 1)
    assert by_file["x/same.csv"][0] != by_file["y/same.csv"][0]
    assert by_file["x/same.csv"][1] == 1 and by_file["y/same.csv"][1] == 2 and len(by_file) == 4
    us = spark.read.parquet(folder + "/out/source_name=USvideos")
    assert dict(us.dtypes)["id"] == "int" and us.agg(F.sum("n")).first()[0] == 6
    bad = spark.read.parquet(folder + "/out").filter("_corrupt_record IS NOT NULL").collect()
    assert [r._corrupt_record for r in bad] == ["9,10,11"]


def test_inferred_scan_and_region_filter(spark, folder):
    put(folder, "a/one.csv", "region,n\nus,1\n")
    put(folder, "b/c/two.CSV", "region,n\nCA,2\n")
    put(folder, "b/three.tsv", "region,n\nus,3\n")
    found = read_csv_inferred(spark, folder)
    assert found.agg(F.sum("n")).first()[0] == 3
    assert in_regions(found, ["ca"]).first().n == 2


def test_convert_in_bounded_jobs(spark, folder, monkeypatch):
    monkeypatch.setattr("trendmark.sinks.convert.FILES_PER_JOB", 2)
    for i in range(5):
        put(folder, f"in/f{i}.csv", f"id,n\n{i},{i}\n")
    manifest = convert_csv(spark, folder + "/in", folder + "/out")
    assert {(r.dest, r.rows) for r in manifest.collect()} == {(f"f{i}", 1) for i in range(5)}
    assert spark.read.parquet(folder + "/out").agg(F.sum("n")).first()[0] == 10


def test_types_hold_for_a_layout_over_all_groups(spark, folder, monkeypatch):
    monkeypatch.setattr("trendmark.sinks.convert.FILES_PER_JOB", 1)
    put(folder, "in/a.csv", "id,n,d,e\n1,1,2024-01-01,\n")
    put(folder, "in/b.csv", "id,n,d,e\nx,1.5,2024-01-01 10:00:00,7\n")
    put(folder, "in/c.csv", "id,n,d,e\n")
    manifest = convert_csv(spark, folder + "/in", folder + "/out")
    assert {(r.dest, r.rows) for r in manifest.collect()} == {("a", 1), ("b", 1), ("c", 0)}
    found = spark.read.parquet(folder + "/out")
    kinds = dict(found.dtypes)
    assert (kinds["id"], kinds["n"], kinds["d"], kinds["e"]) == ("string", "double", "timestamp", "int")
    assert {(r.id, r.n, r.e) for r in found.collect()} == {("1", 1.0, None), ("x", 1.5, 7)}


def test_convert_nothing(spark, folder):
    put(folder, "in/empty.csv", "")
    assert convert_csv(spark, folder + "/in", folder + "/out").count() == 0


def test_convert_csv_leaves_broken_files_out(spark, folder):
    for i in range(5):
        put(folder, f"in/f{i}.csv", f"id,n\n{i},{i}\n")
    wide = ",".join(map(str, range(30_000)))  # more columns than the reader takes
    put(folder, "in/wide.csv", wide + "\n")
    put(folder, "in/g.csv", "id,n\n" + wide + "\n" + "1,2\n")
    manifest = {Path(r.source).name: r for r in convert_csv(spark, folder + "/in", folder + "/out").collect()}
    assert {name for name, r in manifest.items() if r.status == "failed"} == {"wide.csv", "g.csv"}
    assert all(r.rows == 1 and r.error is None for name, r in manifest.items() if name.startswith("f"))
    assert all(r.rows == 0 and r.error for name, r in manifest.items() if r.status == "failed")
    assert sorted(r.id for r in spark.read.parquet(folder + "/out").collect()) == [0, 1, 2, 3, 4]


def test_fetches_of_one_second_stay_apart(spark, folder):
    at = datetime(2026, 7, 14, 10, 5)
    fetch = lambda *texts: spark.createDataFrame([(t, at) for t in texts], "doc string, at timestamp")
    for rows in (fetch('{"a": 1}', '{"a": 1}'), fetch('{"b": 2}'), fetch('{"a": 1}', '{"a": 1}'), fetch('{"b": 2}')):
        write_raw_documents(rows, "doc", F.col("at"), folder + "/raw")
    found = spark.read.text(folder + "/raw").collect()
    assert sorted(r.value for r in found) == ['{"a": 1}', '{"a": 1}', '{"b": 2}']
    assert len({r.ingestion_id for r in found}) == 2 and all(r.ingestion_id.startswith("20260714_100500-") for r in found)


def test_category_rules(spark):
    documents = categories(
        spark,
        ({"items": [category("1", "old"), category("1", "new"), category("2", " "), {"snippet": {"title": "x"}}, category(" ", "y")]}, "ref/region=us/a.json", 1),
        ({"items": []}, "ref/region=ca/b.json", 2),
        ({"kind": "k"}, "ref/region=gb/c.json", 3),
        ("{ broken", "ref/region=de/d.json", 4),
    )
    judged = judged_categories(documents)
    found = {r.column: (r.value, r.passed) for r in category_checks(judged).collect()}
    assert found == {"unreadable": (1, False), "no_items": (2, False), "no_id": (2, False), "no_title": (1, True), "repeated_id": (1, True)}
    refused = quarantined_categories(judged).collect()
    assert sorted((r.rule, Path(r._source_file).name) for r in refused) == [
        ("no_id", "a.json"), ("no_id", "a.json"), ("no_items", "b.json"), ("no_items", "c.json"), ("unreadable", "d.json")
    ]
    assert sorted((r.id, r["snippet.title"]) for r in refine_reference(documents.filter("_corrupt_record is null")).collect()) == [("1", "new"), ("2", " ")]
    assert {r.passed for r in category_checks(judged_categories(documents.limit(0))).collect()} == {True}


def test_raw_documents_are_packed_and_made_twice_at_most(spark, folder):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        made.add(1)
        return '{"items": [], "filler": "' + "same words again " * 60 + '", "n": ' + str(i) + "}"

    at = F.lit(datetime(2026, 7, 14, 10, 5))
    texts = spark.range(0, 400, 1, 2).select(text("id").alias("doc"), at.alias("at"))
    write_raw_documents(texts, "doc", F.col("at"), folder + "/raw")
    assert made.value <= 2 * 400
    files = [p for p in Path(folder, "raw").rglob("part-*") if not p.name.startswith(".")]
    assert sum(p.stat().st_size for p in files) < 400 * 100
    assert spark.read.text(folder + "/raw").count() == read_documents(spark, folder + "/raw", VIDEO_ITEM, multi_line=False).count() == 400


def test_drifting_files_are_made_from_rows_made_once(spark, folder):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(title):
        made.add(1)
        return title

    regions = ["af", "am", "as", "eu", "mi", None]
    rows = raw(spark, *[{"region": regions[i % 6], "title": f"t{i}"} for i in range(60)]).withColumn("title", told("title"))
    write_drifting_csv(rows, folder + "/drift")
    assert made.value == 60
    found = normalize_csv(read_csv_snapshots(spark, folder + "/drift")).collect()
    assert sorted((r.region, r.title) for r in found) == sorted((regions[i % 6], f"t{i}") for i in range(60) if i % 6 < 5)


def test_line_items_of_a_task_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(snapshot_module, "TASK_ROWS", 50)
    items = spark.range(0, 2000, 1, 8).select(F.col("id").alias("l_orderkey"), (F.col("id") % 700).alias("l_partkey"))
    dealt = by_part(items)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 30 and max(sizes) < 150 and sum(sizes) == 2000
    few = items.coalesce(2)
    assert by_part(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
