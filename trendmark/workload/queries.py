"""One query for each operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmark.config import CATEGORY, CHANNEL, REFERENCE, STATISTICS, TRENDING, QualityRules
from trendmark.functions import (
    clean_region,
    field_or,
    item_count,
    parse_trending_date,
    partition_stamps,
    path_value,
    region_code,
    url_decoded,
)
from trendmark.operators.cleanse import cleanse, drop_keyless, fill_counters, with_audit
from trendmark.operators.dedup import keep_latest_snapshot
from trendmark.operators.lookup import attach_category_names, category_lookup
from trendmark.operators.normalize import ARRIVED_AT, normalize_csv, normalize_json, union_sources
from trendmark.operators.quality import (
    TableChecks,
    failures,
    inline_negative_views,
    inline_null_counts,
    run_checks,
    verdict,
)
from trendmark.operators.ranking import rank_channels
from trendmark.operators.reference import category_items, keep_last_category
from trendmark.operators.rollups import (
    category_rollup,
    channel_rollup,
    channel_totals,
    ingestion_summary,
    rows_by,
    top_categories,
    top_channels,
    trending_rollup,
    with_view_share,
)
from trendmark.operators.validation import category_checks, judged_categories, quarantined_categories
from trendmark.plans.gold import enrich, gold_category, gold_channel, gold_trending
from trendmark.plans.medallion import MedallionConfig, build_gold, check_silver, gate, publish_statistics
from trendmark.plans.silver import silver_statistics, stage_row_counts
from trendmark.schemas import CATEGORY_ITEM, SNAPSHOT_COLUMNS, VIDEO_ITEM
from trendmark.session import scratch_path
from trendmark.sinks import convert_csv, publish, write_partitioned, write_raw_documents
from trendmark.sources import (
    TableStore,
    explode_documents,
    parse_documents,
    read_csv_inferred,
    read_csv_snapshots,
    read_documents,
    sample,
)
from trendmark.sources.csv_snapshots import in_regions
from trendmark.streaming import (
    FirstArrivals,
    IncrementalMedallion,
    ReferenceArrivals,
    SnapshotUpsert,
    VideoArrivals,
    first_seen,
    run_available,
    stream_csv_snapshots,
    stream_documents,
)
from trendmark.workload.snapshot import (
    REGIONS,
    category_documents,
    envelope_documents,
    nation_reference,
    region_documents,
    single_documents,
    snapshot,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]

NOW = datetime(2024, 2, 1)
JOB = "medallion"
KEY = ["video_id", "region", "trending_date_parsed"]
SILVER_COLUMNS = [*SNAPSHOT_COLUMNS, "trending_date_parsed", "like_ratio", "engagement_rate"]
QUERIES: dict[str, Query] = {}


def query(key: str) -> Callable[[Query], Query]:
    """Register a query under a key."""

    def register(function: Query) -> Query:
        QUERIES[key] = function
        return function

    return register


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Averages to four digits. The nudge keeps exact halves from depending on the order of summing."""
    return df.withColumns({name: F.round(F.col(name) + 1e-9, 4) for name in names})


def text_of(moment: Column | str) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def cleansed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse(snapshot(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_statistics(snapshot(spark, sf_dir).drop("l_linenumber"), JOB, NOW)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(silver(spark, sf_dir), nation_reference(spark, sf_dir))


def parsed(documents: DataFrame) -> DataFrame:
    return parse_documents(documents, VIDEO_ITEM, "document")


# Sources


def write_csv(df: DataFrame, path: str, *partition_by: str, extension: str = "csv") -> None:
    writer = df.write.option("header", True).option("escape", '"').option("extension", extension)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


@query("csv_scan_roundtrip")
def csv_scan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    rows = snapshot(spark, sf_dir).select(*SNAPSHOT_COLUMNS).withColumn("region", clean_region(F.col("region")))
    write_csv(rows, path, "region")
    return normalize_csv(read_csv_snapshots(spark, path)).select(*SNAPSHOT_COLUMNS)


def write_drifting_csv(rows: DataFrame, path: str) -> None:
    """A layout for each region: as they are, in reverse, one column less and one more, in capitals and sorted.

    The rows are made once and set aside by region.
    """
    aside = scratch_path(rows.sparkSession, "by-region")
    schema = rows.schema
    write_partitioned(rows, aside, rebalance=False)
    rows = rows.sparkSession.read.schema(schema).parquet(aside)
    names = [name for name in SNAPSHOT_COLUMNS if name != "region"]
    layouts = {
        "af": names,
        "am": names,
        "as": names[::-1],
        "eu": ["video_id", "extra", *[name for name in names[1:] if name != "likes"]],
        "mi": [name.upper() for name in sorted(names)],
    }
    rows = rows.withColumn("extra", F.lit('a "quoted", cell'))
    for region, columns in layouts.items():
        write_csv(rows.filter(F.col("region") == region).select(*[F.col(c.lower()).alias(c) for c in columns]), f"{path}/region={region}")


@query("csv_scan_drift")
def csv_scan_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv-drift")
    write_drifting_csv(snapshot(spark, sf_dir).withColumn("region", clean_region(F.col("region"))), path)
    return normalize_csv(read_csv_snapshots(spark, path)).select(*SNAPSHOT_COLUMNS)


@query("json_scan_roundtrip")
def json_scan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    write_raw_documents(single_documents(snapshot(spark, sf_dir)), "document", F.col(ARRIVED_AT), path)
    documents = read_documents(spark, path, VIDEO_ITEM, multi_line=False)
    return normalize_json(explode_documents(documents, VIDEO_ITEM)).select(*SNAPSHOT_COLUMNS)


@query("json_items_explode")
def json_items_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = explode_documents(parsed(region_documents(snapshot(spark, sf_dir))), VIDEO_ITEM)
    return items.select(
        F.col("id").alias("video_id"),
        F.col("snippet.title").alias("title"),
        "region",
        F.col("_position").cast("int").alias("position"),
    )


@query("json_envelope_flatten")
def json_envelope_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = explode_documents(parsed(envelope_documents(snapshot(spark, sf_dir))), VIDEO_ITEM)
    return items.select(
        F.col("id").alias("video_id"),
        "region",
        F.col("statistics.viewCount").alias("view_text"),
        text_of(ARRIVED_AT).alias("arrived_at"),
    )


def categories(spark: SparkSession, sf_dir: str, bare: bool = False) -> DataFrame:
    documents = category_documents(spark, sf_dir, bare)
    return parse_documents(documents, CATEGORY_ITEM, "value", F.col("key"), F.col("landed_at"))


def as_category_rows(items: DataFrame) -> DataFrame:
    return items.select(
        "id", F.col("`snippet.title`").alias("snippet_title"), "region", F.col("_source_file").alias("source_file")
    )


@query("category_flatten")
def category_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_category_rows(category_items(categories(spark, sf_dir), fallback=False))


@query("category_fallback")
def category_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_category_rows(category_items(categories(spark, sf_dir, bare=True), fallback=True))


@query("csv_glob_scan")
def csv_glob_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "glob")
    rows = table(spark, sf_dir, "lineitem").select("l_linestatus", "l_returnflag", "l_extendedprice")
    write_csv(rows, f"{path}/lower")
    write_csv(rows, f"{path}/deep/er/upper", extension="CSV")
    write_csv(rows, f"{path}/other", extension="tsv")
    found = read_csv_inferred(spark, path, multi_line=False)
    return found.groupBy("l_linestatus", "l_returnflag").agg(
        F.count("*").alias("rows"), F.round(F.sum("l_extendedprice"), 2).alias("price")
    )


@query("csv_infer")
def csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "infer")
    write_csv(table(spark, sf_dir, "part"), path)
    found = read_csv_inferred(spark, path)
    types = F.lit("|".join(f"{name}:{kind}" for name, kind in found.dtypes))
    return found.select(F.col("p_partkey").cast("bigint"), "p_name", "p_retailprice", types.alias("types"))


@query("path_region_extract")
def path_region_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot(spark, sf_dir)
    stamps = partition_stamps(F.col(ARRIVED_AT))
    folder = F.when(F.col("views") > 0, F.concat(F.lit("region="), clean_region(F.col("region")), F.lit("/")))
    path = F.concat(
        F.lit("raw/"), F.coalesce(folder, F.lit("")), F.lit("date="), stamps["date"], F.lit("/hour="), stamps["hour"],
        F.lit("/x.json"),
    )
    return rows.select(path.alias("path")).select(
        "path",
        path_value(F.col("path"), "region").alias("region"),
        path_value(F.col("path"), "date").alias("date"),
        path_value(F.col("path"), "hour").alias("hour"),
    )


@query("region_in_filter")
def region_in_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "regions")
    rows = cleansed(spark, sf_dir).select(*KEY, "views")
    write_partitioned(rows, path)
    return in_regions(spark.read.parquet(path), ["eu", " AF "]).select(*KEY, "views")


@query("source_key_decode")
def source_key_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = F.concat(
        F.lit("raw%2Fregion%3D"), clean_region(F.col("region")), F.lit("%2F"), F.replace("tags", F.lit("|"), F.lit("+")),
        F.lit(".json"),
    )
    keys = snapshot(spark, sf_dir).select(encoded.alias("encoded"))
    return keys.select("encoded", url_decoded(F.col("encoded")).alias("decoded"))


@query("dq_sample_limit")
def dq_sample_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = QualityRules(sample_rows=10_000)
    checks = TableChecks(sample(cleansed(spark, sf_dir), rules.sample_rows), STATISTICS, rules, NOW)
    return checks.rows(checks.row_count()).select("check", "table", "value", "passed")


# Sinks


@query("sink_partitioned_parquet")
def sink_partitioned_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = scratch_path(spark, "layers")
    config = MedallionConfig(TableStore(spark, f"{layers}/silver"), TableStore(spark, f"{layers}/gold"))
    publish_statistics(silver(spark, sf_dir), config)
    return config.silver.read(STATISTICS).select(*SILVER_COLUMNS)


@query("sink_dynamic_overwrite")
def sink_dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "overwrite")
    rows = cleansed(spark, sf_dir).select("video_id", "region", "trending_date_parsed", "views", "likes")
    write_partitioned(rows, path)
    replaced = rows.filter(F.col("region") == "eu").withColumn("views", F.col("views") * 2)
    write_partitioned(replaced, path)
    return spark.read.parquet(path).select("video_id", "region", "trending_date_parsed", "views", "likes")


@query("schema_evolution_union")
def schema_evolution_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = TableStore(spark, scratch_path(spark, "evolve"))
    rows = cleansed(spark, sf_dir).select("video_id", "region", "views", "likes")
    older = rows.filter(F.col("region").isin("af", "am"))
    write_partitioned(older.drop("likes"), store.path(STATISTICS))
    write_partitioned(rows.join(older.select("region").distinct(), "region", "left_anti"), store.path(STATISTICS))
    return store.read(STATISTICS, merge_schema=True).select("video_id", "region", "views", "likes")


@query("bronze_json_sink")
def bronze_json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    write_raw_documents(envelope_documents(snapshot(spark, sf_dir)), "document", F.col(ARRIVED_AT), path)
    documents = read_documents(spark, path, VIDEO_ITEM, multi_line=False)
    file = F.col("_source_file")
    return documents.groupBy(
        path_value(file, "date").alias("date"), path_value(file, "hour").alias("hour"), "ingestion_id", "fetched_at"
    ).agg(F.count("*").alias("documents"))


@query("bronze_json_same_second")
def bronze_json_same_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fetches of every second, the first landed again after the second: both stay, once."""
    path = scratch_path(spark, "bronze")
    rows = snapshot(spark, sf_dir)
    even = F.col("category_id") % 2 == 0
    for fetch in (even, ~even, even):
        write_raw_documents(envelope_documents(rows.filter(fetch)), "document", F.col(ARRIVED_AT), path)
    documents = read_documents(spark, path, VIDEO_ITEM, multi_line=False)
    return rows_by(documents, "ingestion_id", name="documents")


@query("csv_to_parquet")
def csv_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, dest = scratch_path(spark, "csv-in"), scratch_path(spark, "parquet-out")
    write_csv(table(spark, sf_dir, "orders"), f"{path}/orders")
    convert_csv(spark, path, dest)
    return spark.read.parquet(dest).select(
        F.col("o_orderkey").cast("bigint"),
        F.col("o_custkey").cast("bigint"),
        "o_orderstatus",
        "o_totalprice",
        F.col("o_orderdate").cast("date"),
        "o_orderpriority",
        F.col("_corrupt_record").alias("corrupt"),
    )


@query("conversion_manifest")
def conversion_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, dest = scratch_path(spark, "csv-in"), scratch_path(spark, "parquet-out")
    write_csv(table(spark, sf_dir, "orders"), f"{path}/orders")
    write_csv(table(spark, sf_dir, "customer"), f"{path}/customer", extension="CSV")
    # A file with more columns than can be read, and the others beside it.
    cells = F.transform(F.sequence(F.lit(1), F.lit(30_000)), lambda i: i.cast("string"))
    broken = table(spark, sf_dir, "region").limit(1).select(F.array_join(cells, ",").alias("value"))
    broken.coalesce(1).write.option("sep", ";").csv(f"{path}/broken")
    manifest = convert_csv(spark, path, dest)
    layout = F.regexp_extract("source", r"/(orders|customer|broken)/[^/]*$", 1)
    return manifest.groupBy(layout.alias("layout"), "status").agg(
        F.sum("rows").alias("rows"), (F.countDistinct("dest") == F.count("*")).alias("one_output_each")
    )


# Projections and filters


def as_text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows as a file would give them, with numbers that are none."""
    rows = snapshot(spark, sf_dir)
    texts = {name: F.col(name).cast("string") for name in SNAPSHOT_COLUMNS}
    texts["views"] = F.when(F.col("views") == 0, "none").otherwise(texts["views"])
    return rows.select(*[column.alias(name) for name, column in texts.items()], ARRIVED_AT)


@query("normalize_csv")
def normalize_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_csv(as_text_rows(spark, sf_dir)).select(*SNAPSHOT_COLUMNS)


@query("normalize_json")
def normalize_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = parsed(single_documents(snapshot(spark, sf_dir)))
    return normalize_json(explode_documents(documents, VIDEO_ITEM)).select(*SNAPSHOT_COLUMNS)


@query("optional_column")
def optional_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot(spark, sf_dir).select("category_id", "title")
    shapes = {
        "nested": rows.select("category_id", F.struct("title").alias("snippet")),
        "dotted": rows.withColumnRenamed("title", "snippet.title"),
        "doubled": rows.withColumnRenamed("title", "snippet__title"),
        "flat": rows.withColumnRenamed("title", "snippet_title"),
        "absent": rows.drop("title"),
    }
    found = [
        df.select(F.lit(shape).alias("shape"), field_or(df, "snippet.title", "string", "none").alias("title"))
        for shape, df in shapes.items()
    ]
    return rows_by(reduce(DataFrame.unionByName, found), "shape", "title")


@query("filter_null_key")
def filter_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_keyless(snapshot(spark, sf_dir)).select("video_id", "region", "trending_date", "views")


@query("region_canonical")
def region_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot(spark, sf_dir).select(F.col("region").alias("raw"), clean_region(F.col("region")).alias("region"))
    return rows_by(rows, "raw", "region")


@query("parse_trending_date")
def parse_trending_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot(spark, sf_dir)
    dated = rows.select("trending_date", parse_trending_date(F.col("trending_date")).alias("trending_date_parsed"))
    return rows_by(dated, "trending_date", "trending_date_parsed")


@query("fill_null_counters")
def fill_null_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_counters(snapshot(spark, sf_dir)).select(
        "video_id", "trending_date", "views", "likes", "dislikes", "comment_count"
    )


@query("derive_like_ratio")
def derive_like_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleansed(spark, sf_dir).select(*KEY, "views", "likes", "like_ratio")


@query("derive_engagement_rate")
def derive_engagement_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleansed(spark, sf_dir).select(*KEY, "views", "engagement_rate")


@query("audit_columns")
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_audit(snapshot(spark, sf_dir), "_processed_at", NOW, _job_name=JOB)
    rows = with_audit(rows, "_ingestion_timestamp", NOW, as_text=True, _source_file="raw/a.json")
    stamped = rows.select(
        "channel_title",
        text_of("_processed_at").alias("processed_at"),
        F.substring("_ingestion_timestamp", 1, 19).alias("ingestion_timestamp"),
        F.col("_job_name").alias("job_name"),
        F.col("_source_file").alias("source_file"),
    )
    return rows_by(stamped, *stamped.columns)


@query("region_code_upper")
def region_code_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot(spark, sf_dir).select(region_code(F.col("region")).alias("region_code"))
    return rows_by(rows, "region_code")


@query("items_size")
def items_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = categories(spark, sf_dir, bare=True)
    return documents.select(F.col("_source_file").alias("source_file"), item_count(F.col("items")).alias("item_count"))


@query("partition_stamps")
def partition_stamp_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    stamps = partition_stamps(F.col("ts"))
    return events.select("event_id", *[column.alias(name) for name, column in stamps.items()])


# Joins


@query("lookup_join")
def lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = enrich(cleansed(spark, sf_dir), nation_reference(spark, sf_dir))
    return named.select("category_id", "category_name", *KEY, "views")


@query("lookup_shapes")
def lookup_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference = nation_reference(spark, sf_dir)
    title = F.col("`snippet.title`")
    shapes = {
        "dotted": reference,
        "nested": reference.select("id", "region", F.struct(title.alias("title")).alias("snippet")),
        "flat": reference.select("id", "region", title.alias("snippet_title")),
        "neither": reference.select("id", "region"),
    }
    found = []
    for shape, df in shapes.items():
        named = attach_category_names(cleansed(spark, sf_dir).select("category_id"), category_lookup(df))
        found.append(rows_by(named, "category_name").select(F.lit(shape).alias("shape"), "category_name", "cnt"))
    return reduce(DataFrame.unionByName, found)


@query("category_lookup")
def category_lookup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference = table(spark, sf_dir, "part").select(
        F.substring("p_brand", 7, 10).alias("id"),
        F.concat("p_type", F.lit(" "), "p_name").alias("snippet.title"),
        F.concat(F.lit("r"), (F.col("p_size") % 5).cast("string")).alias("region"),
    )
    return category_lookup(reference)


# Aggregates


@query("gold_trending")
def gold_trending_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold_trending(silver(spark, sf_dir), NOW).drop("_aggregated_at")
    return rounded(rows, "avg_views_per_video", "avg_like_ratio", "avg_engagement_rate")


def channel_table(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("categories", F.array_join("categories", "|"))
    return rounded(rows, "avg_views_per_video", "avg_engagement_rate")


@query("gold_channel")
def gold_channel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return channel_table(gold_channel(enriched(spark, sf_dir), NOW).drop("_aggregated_at"))


@query("gold_category")
def gold_category_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold_category(enriched(spark, sf_dir), NOW).drop("_aggregated_at"), "avg_engagement_rate")


@query("gold_without_reference")
def gold_without_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold_category(enrich(silver(spark, sf_dir), None), NOW).drop("_aggregated_at")
    return rounded(rows, "avg_engagement_rate")


@query("approx_unique_channels")
def approx_unique_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleansed(spark, sf_dir)
    exact = trending_rollup(rows).select("region", "trending_date_parsed", "unique_channels")
    near = trending_rollup(rows, approx_rsd=0.02).select(
        F.col("region").alias("_region"),
        F.col("trending_date_parsed").alias("_day"),
        F.col("unique_channels").alias("_near"),
    )
    same = F.col("region").eqNullSafe(F.col("_region")) & F.col("trending_date_parsed").eqNullSafe(F.col("_day"))
    off = F.abs(F.col("unique_channels") - F.col("_near"))
    close = off <= F.greatest(F.lit(1.0), F.col("unique_channels") * 0.1)
    return exact.join(near, same).select("region", "trending_date_parsed", "unique_channels", close.alias("close"))


@query("channel_categories")
def channel_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = channel_rollup(enriched(spark, sf_dir))
    return rows.select("channel_title", "region", F.array_join("categories", "|").alias("categories"))


@query("stage_row_counts")
def stage_row_count_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_row_counts(snapshot(spark, sf_dir))


@query("inline_null_counts")
def inline_null_count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inline_null_counts(snapshot(spark, sf_dir), ("video_id", "title", "channel_title", "views", "likes"))


@query("inline_negative_views")
def inline_negative_view_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inline_negative_views(snapshot(spark, sf_dir).withColumn("views", F.col("views") - 5_000))


@query("rows_per_region")
def rows_per_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_by(silver(spark, sf_dir), "region")


@query("rows_per_source")
def rows_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = keep_last_category(category_items(categories(spark, sf_dir)))
    return rows_by(kept.withColumnRenamed("_source_file", "source_file"), "source_file", "region")


@query("ingestion_summary")
def ingestion_summary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = parsed(envelope_documents(snapshot(spark, sf_dir)))
    counts = F.transform_values("regions", lambda _, payload: item_count(payload["items"]))
    payloads = documents.select("ingestion_id", F.explode(counts).alias("region", "video_count"))
    return ingestion_summary(payloads, [*REGIONS, " xx "])


# Windows, order, sets


@query("silver_dedup")
def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest_snapshot(cleansed(spark, sf_dir)).select(*SILVER_COLUMNS)


@query("channel_rank")
def channel_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = silver(spark, sf_dir).groupBy("channel_title", "region").agg(F.sum("views").alias("total_views"))
    return rank_channels(totals)


@query("category_view_share")
def category_view_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_view_share(category_rollup(enriched(spark, sf_dir)))
    return rows.select(
        "category_name", "category_id", "region", "trending_date_parsed", "total_views", "view_share_pct"
    )


@query("top_channels")
def top_channel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_channels(channel_totals(silver(spark, sf_dir)), "eu")


@query("top_categories")
def top_category_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_categories(with_view_share(category_rollup(enriched(spark, sf_dir))), "am")


@query("union_sources")
def union_of_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = normalize_csv(as_text_rows(spark, sf_dir))
    live = normalize_json(explode_documents(parsed(single_documents(snapshot(spark, sf_dir))), VIDEO_ITEM))
    return union_sources(history, live).select("video_id", "trending_date", "title", "views", "tags", "region")


@query("union_empty_side")
def union_empty_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = normalize_csv(as_text_rows(spark, sf_dir))
    nothing = explode_documents(parsed(single_documents(snapshot(spark, sf_dir).filter(F.lit(False)))), VIDEO_ITEM)
    return union_sources(history, normalize_json(nothing)).select("video_id", "trending_date", "title", "region")


@query("category_keep_last")
def category_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_category_rows(keep_last_category(category_items(categories(spark, sf_dir), fallback=False)))


@query("category_validation")
def category_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category documents without ids, items or titles, and cut short: what each rule finds, and what is refused."""
    size = F.col("p_size")
    dirty = (
        F.when(size == 2, F.replace("value", F.lit('"id"'), F.lit('"key"')))
        .when(size == 3, F.lit('{"items": []}'))
        .when(size == 4, F.left("value", F.lit(40)))
        .when(size == 5, F.replace("value", F.lit('"title"'), F.lit('"name"')))
        .otherwise(F.col("value"))
    )
    documents = parse_documents(category_documents(spark, sf_dir).withColumn("value", dirty), CATEGORY_ITEM, "value", F.col("key"), F.col("landed_at"))
    judged = judged_categories(documents)
    refused = quarantined_categories(judged).groupBy("rule").agg(F.count("*").alias("refused"))
    checks = category_checks(judged).select(F.col("column").alias("rule"), "value", "passed")
    return checks.join(refused, "rule", "left").select("rule", "value", "passed", F.coalesce("refused", F.lit(0)).alias("refused"))


# Quality


def silver_checks(spark: SparkSession, sf_dir: str) -> TableChecks:
    return TableChecks(silver(spark, sf_dir), STATISTICS, QualityRules(), NOW)


@query("dq_row_count")
def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = silver_checks(spark, sf_dir)
    return checks.rows(checks.row_count()).select("check", "table", "value", "threshold", "passed")


@query("dq_null_pct")
def dq_null_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = QualityRules(max_null_pct=1.0)
    checks = TableChecks(snapshot(spark, sf_dir).drop("region"), STATISTICS, rules, NOW)
    return checks.rows(checks.null_percentage()).select("check", "table", "column", "value", "threshold", "passed")


@query("dq_schema")
def dq_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = TableChecks(snapshot(spark, sf_dir).drop("title", "region"), STATISTICS, QualityRules(), NOW)
    rows = checks.rows(checks.row_count(), checks.schema())
    return rows.select("check", "table", "passed", F.array_join("missing_columns", "|").alias("missing"))


@query("dq_value_range")
def dq_value_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    wild = F.when(F.col("views") > 100_000, 50_000_000_001).otherwise(F.col("views") - 5_000)
    checks = TableChecks(snapshot(spark, sf_dir).withColumn("views", wild), STATISTICS, QualityRules(), NOW)
    rows = checks.rows(checks.value_ranges())
    return rows.select("check", "table", "column", "negative_count", "extreme_count", "passed")


@query("dq_freshness")
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    live = events.withColumnRenamed("ts", "_processed_at")
    as_text = events.select(F.col("ts").cast("string").alias("_ingestion_timestamp"))
    unreadable = events.select(F.col("event_type").alias("_ingestion_timestamp"))
    nameless = events.select("event_id")
    tables = {"live": live, "text": as_text, "unreadable": unreadable, "none": nameless}
    found = []
    for name, df in tables.items():
        checks = TableChecks(df, name, QualityRules(), NOW)
        found.append(checks.rows(checks.freshness()))
    return reduce(DataFrame.unionByName, found).select("check", "table", "latest_record", "cutoff", "passed")


@query("dq_read_table")
def dq_read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = scratch_path(spark, "missing")
    readers = {STATISTICS: lambda: silver(spark, sf_dir), REFERENCE: lambda: spark.read.parquet(missing)}
    return run_checks(spark, readers, QualityRules(), NOW).select("check", "table", "column", "passed")


def all_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    readers = {
        STATISTICS: lambda: silver(spark, sf_dir).withColumn("views", F.col("views") - 5_000),
        REFERENCE: lambda: with_audit(
            category_items(categories(spark, sf_dir)), "_ingestion_timestamp", datetime(2024, 1, 1), as_text=True
        ),
    }
    return run_checks(spark, readers, QualityRules(), NOW)


@query("dq_summary")
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict(all_checks(spark, sf_dir)).select(
        "quality_passed", "checks_passed", "checks_total", F.size("details").alias("details")
    )


@query("dq_failures")
def dq_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failures(all_checks(spark, sf_dir)).select("check", "table", "column")


def gold_written(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Gold table as a gated run has written it."""
    layers = scratch_path(spark, "layers")
    config = MedallionConfig(TableStore(spark, f"{layers}/silver"), TableStore(spark, f"{layers}/gold"))
    publish_statistics(silver(spark, sf_dir), config)
    reference = with_audit(nation_reference(spark, sf_dir), "_ingestion_timestamp", NOW, as_text=True)
    publish(reference, config.silver, REFERENCE)
    gate(check_silver(spark, config, NOW))
    build_gold(config, NOW)
    return config.gold.read(name).drop("_aggregated_at")


@query("gated_gold")
def gated_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold_written(spark, sf_dir, TRENDING)
    return rounded(rows, "avg_views_per_video", "avg_like_ratio", "avg_engagement_rate")


@query("gated_gold_channel")
def gated_gold_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return channel_table(gold_written(spark, sf_dir, CHANNEL))


@query("gated_gold_category")
def gated_gold_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold_written(spark, sf_dir, CATEGORY), "avg_engagement_rate")


# Incremental


def land(spark: SparkSession, documents: DataFrame, path: str) -> None:
    write_raw_documents(documents, "document", F.col(ARRIVED_AT), path)


@query("incremental_ingest")
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two waves of files under one checkpoint: the second run reads the second wave alone."""
    root = scratch_path(spark, "ingest")
    store = TableStore(spark, f"{root}/silver")
    rows = snapshot(spark, sf_dir)
    handler = SnapshotUpsert(store, f"{root}/checkpoint", JOB, NOW)
    for wave in (F.col("l_linenumber") > 3, F.col("l_linenumber") <= 3):
        land(spark, single_documents(rows.filter(wave)), f"{root}/raw")
        stream = stream_documents(spark, f"{root}/raw", VIDEO_ITEM, multi_line=False)
        run_available(normalize_json(explode_documents(stream, VIDEO_ITEM)), handler, f"{root}/checkpoint")
    return store.read(STATISTICS).select(*SILVER_COLUMNS)


def arrivals(spark: SparkSession, sf_dir: str, wave: Column) -> DataFrame:
    """Normalised rows of the documents of a wave; the others are not parsed for it."""
    documents = single_documents(snapshot(spark, sf_dir)).filter(wave)
    return normalize_json(explode_documents(parsed(documents), VIDEO_ITEM))


@query("incremental_upsert")
def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches out of order, one of them repeated: each day still ends with its latest rows."""
    root = scratch_path(spark, "upsert")
    store = TableStore(spark, f"{root}/silver")
    handler = SnapshotUpsert(store, f"{root}/checkpoint", JOB, NOW)
    hour = F.hour(ARRIVED_AT)
    waves = [hour >= 5, hour <= 2, (hour > 2) & (hour < 5)]
    for batch_id, wave in enumerate(waves):
        handler(arrivals(spark, sf_dir, wave), batch_id)
    handler(arrivals(spark, sf_dir, waves[-1]), len(waves) - 1)
    return store.read(STATISTICS).select(*SILVER_COLUMNS)


@query("incremental_gold")
def incremental_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three waves, the later ones of some days each: Gold follows and ends as a full rebuild would have it."""
    root = scratch_path(spark, "incremental-gold")
    silver_store, gold_store = TableStore(spark, f"{root}/silver"), TableStore(spark, f"{root}/gold")
    reference = with_audit(nation_reference(spark, sf_dir), "_ingestion_timestamp", NOW, as_text=True)
    publish(reference, silver_store, REFERENCE)
    handler = IncrementalMedallion(silver_store, gold_store, f"{root}/checkpoint", JOB, now=NOW)
    early, hour = F.dayofmonth(ARRIVED_AT) <= 3, F.hour(ARRIVED_AT)
    for batch_id, wave in enumerate([hour >= 5, (hour < 5) & ~early, (hour < 5) & early]):
        handler(arrivals(spark, sf_dir, wave), batch_id)
    channel = gold_store.read(CHANNEL).select(
        F.lit("channel").alias("table"), "region", F.col("channel_title").alias("name"), F.lit(None).cast("date").alias("day"),
        "total_views", F.col("total_videos").alias("videos"), F.col("rank_in_region").cast("double").alias("place"),
    )
    category = gold_store.read(CATEGORY).select(
        F.lit("category").alias("table"), "region", F.col("category_name").alias("name"), F.col("trending_date_parsed").alias("day"),
        "total_views", F.col("video_count").alias("videos"), F.col("view_share_pct").alias("place"),
    )
    trending = gold_store.read(TRENDING).select(
        F.lit("trending").alias("table"), "region", F.lit(None).cast("string").alias("name"), F.col("trending_date_parsed").alias("day"),
        "total_views", F.col("total_videos").alias("videos"), F.col("unique_channels").cast("double").alias("place"),
    )
    return channel.unionByName(category).unionByName(trending)


@query("incremental_reference")
def incremental_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category documents as they land, those of size 1 cut short; the latter are counted."""
    root = scratch_path(spark, "reference")
    store = TableStore(spark, f"{root}/silver")
    documents = category_documents(spark, sf_dir)
    cut = F.when(F.col("p_size") == 1, F.expr("left(value, 40)")).otherwise(F.col("value"))
    folder = F.regexp_extract(url_decoded(F.col("key")), "region=(R[0-9])/", 1)
    landed = documents.select(cut.alias("value"), folder.alias("region"))
    landed.write.partitionBy("region").text(f"{root}/raw")
    stream = stream_documents(spark, f"{root}/raw", CATEGORY_ITEM, multi_line=False)
    run_available(stream, ReferenceArrivals(store, f"{root}/quarantine", NOW), f"{root}/checkpoint")
    kept = store.read(REFERENCE).select("region", "id", F.col("`snippet.title`").alias("snippet_title"))
    quarantined = spark.read.parquet(f"{root}/quarantine").agg(F.count("*").cast("string").alias("id"))
    return kept.unionByName(
        quarantined.select(F.lit("quarantine").alias("region"), "id", F.lit(None).cast("string").alias("snippet_title"))
    )


@query("incremental_quarantine")
def incremental_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video documents as they land, some cut short: the others reach Silver, and those are kept."""
    root = scratch_path(spark, "quarantine")
    store = TableStore(spark, f"{root}/silver")
    rows = snapshot(spark, sf_dir)
    documents = single_documents(rows.filter(F.col("l_linenumber").isNotNull()), "l_linenumber")
    cut = F.when(F.col("l_linenumber") == 2, F.left("document", F.lit(40))).otherwise(F.col("document"))
    land(spark, documents.withColumn("document", cut), f"{root}/raw")
    handler = VideoArrivals(SnapshotUpsert(store, f"{root}/checkpoint", JOB, NOW), f"{root}/quarantine")
    run_available(stream_documents(spark, f"{root}/raw", VIDEO_ITEM, multi_line=False), handler, f"{root}/checkpoint")
    kept = rows_by(store.read(STATISTICS), "region", "trending_date_parsed")
    bad = spark.read.parquet(f"{root}/quarantine").agg(F.count("*").alias("cnt"))
    return kept.unionByName(bad.select(F.lit("quarantine").alias("region"), F.lit(None).cast("date").alias("trending_date_parsed"), "cnt"))


@query("incremental_late_arrivals")
def incremental_late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three waves, the later ones of earlier days and with repeats: first arrivals on time and late."""
    root = scratch_path(spark, "late")
    handler = FirstArrivals(f"{root}/arrivals", "72 hours")
    day = F.dayofmonth(ARRIVED_AT)
    for batch_id, wave in enumerate([day >= 5, day.isin(3, 4, 7), (day <= 2) | (day == 6)]):
        handler(cleanse(arrivals(spark, sf_dir, wave)), batch_id)
    handler(cleanse(arrivals(spark, sf_dir, (day <= 2) | (day == 6))), 2)  # the last one again
    found = [handler.read(spark, late).withColumn("late", F.lit(late)) for late in (False, True)]
    return found[0].unionByName(found[1]).select(*KEY, text_of(ARRIVED_AT).alias("arrived_at"), "late")


@query("incremental_csv")
def incremental_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV snapshots through the file stream."""
    root = scratch_path(spark, "csv-stream")
    rows = snapshot(spark, sf_dir).select(*SNAPSHOT_COLUMNS).withColumn("region", clean_region(F.col("region")))
    write_csv(rows, f"{root}/raw", "region")
    stream = normalize_csv(stream_csv_snapshots(spark, f"{root}/raw")).select(*SNAPSHOT_COLUMNS)
    landed = stream.writeStream.format("parquet").option("path", f"{root}/out")
    landed.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query("incremental_csv_drift")
def incremental_csv_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of several layouts through the file stream, in batches that mix them."""
    root = scratch_path(spark, "csv-drift-stream")
    write_drifting_csv(snapshot(spark, sf_dir).withColumn("region", clean_region(F.col("region"))), f"{root}/raw")
    stream = normalize_csv(stream_csv_snapshots(spark, f"{root}/raw", max_files=12)).select(*SNAPSHOT_COLUMNS)
    landed = stream.writeStream.format("parquet").option("path", f"{root}/out")
    landed.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query("incremental_dedup_bounded")
def incremental_dedup_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "first-seen")
    land(spark, single_documents(snapshot(spark, sf_dir)), f"{root}/raw")
    stream = stream_documents(spark, f"{root}/raw", VIDEO_ITEM, multi_line=False)
    keyed = cleanse(normalize_json(explode_documents(stream, VIDEO_ITEM))).select(*KEY, ARRIVED_AT)
    landed = first_seen(keyed).writeStream.format("parquet").option("path", f"{root}/out")
    landed.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out").select(*KEY)
