"""Popularity snapshots and raw documents derived from the star-schema tables.

Line items stand for snapshot rows, suppliers for channels and part brands for categories. Dirt (NULL
keys, padded regions, bad dates, missing counters) is put in by fixed rules on the order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmark.operators.normalize import ARRIVED_AT
from trendmark.schemas import SNAPSHOT_COLUMNS
from trendmark.sources import spread

REGIONS = ["AF", "AM", "AS", "EU", "MI"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("l_orderkey") % n == 0


#: Line items of a task. Joined with the columns of their parts these are some 100 MB, which can be sorted in memory.
TASK_ROWS = 250_000


def by_part(items: DataFrame) -> DataFrame:
    """Line items dealt out for their join with parts, in tasks of bounded size.

    Adaptive execution sizes a task by the few columns that are shuffled for the join. The rows are several times wider
    after it, and what sorts them (the deduplication, a partitioned write) would spill all of them.
    """
    splits = items.rdd.getNumPartitions()
    if splits < items.sparkSession.sparkContext.defaultParallelism:
        return spread(items)
    return items.repartition(max(splits, -(-items.count() // TASK_ROWS)), "l_partkey")


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw snapshot rows in the canonical columns, with ``_arrived_at`` and ``l_linenumber``."""
    day = F.add_months(F.col("l_shipdate").cast("date"), 240)
    # How to join is left to Spark: small sides are broadcast by their measured size, large ones shuffled.
    joined = (
        by_part(table(spark, sf_dir, "lineitem"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("code", F.lower(F.substring("r_name", 1, 2)))
    )
    arrived = F.timestamp_add("DAY", (F.col("l_orderkey") % 7).cast("int"), F.lit("2024-01-01").cast("timestamp"))
    columns = {
        "video_id": F.when(~_every(97), F.col("l_partkey").cast("string")),
        "trending_date": F.when(_every(101), "n/a")
        .when(_every(103), "17.32.13")
        .when(_every(2), F.date_format(day, "yy.dd.MM"))
        .otherwise(day.cast("string")),
        "title": F.when(~_every(71), F.col("p_name")),
        "channel_title": F.col("s_name"),
        "category_id": F.substring("p_brand", 7, 10).cast("bigint"),
        "publish_time": F.concat(day.cast("string"), F.lit("T08:00:00.000Z")),
        "tags": F.replace(F.col("p_name"), F.lit(" "), F.lit("|")),
        "views": F.when(_every(41), 0).otherwise(F.floor("l_extendedprice")).cast("bigint"),
        "likes": F.when(~_every(53), F.col("l_quantity").cast("bigint")),
        "dislikes": F.round(F.col("l_discount") * 100).cast("bigint"),
        "comment_count": F.round(F.col("l_tax") * 100).cast("bigint"),
        "thumbnail_link": F.concat(F.lit("https://img.example/"), F.col("l_partkey").cast("string"), F.lit(".jpg")),
        "comments_disabled": F.col("l_returnflag") == "R",
        "ratings_disabled": F.col("l_returnflag") == "A",
        "video_error_or_removed": (F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "N"),
        "description": F.concat(
            "p_type", F.lit(' "'), "p_name", F.lit('"\nsize '), F.col("p_size").cast("string")
        ),
        "region": F.when(_every(7), F.concat(F.lit(" "), F.upper("code"), F.lit(" "))).otherwise(F.col("code")),
    }
    return joined.select(
        *[columns[name].alias(name) for name in SNAPSHOT_COLUMNS],
        F.timestamp_add("HOUR", F.col("l_linenumber"), arrived).alias(ARRIVED_AT),
        "l_linenumber",
    )


def video_item(id_suffix: str = "") -> Column:
    """An API item of a snapshot row: some numbers as text and some as numbers, NULL fields left out."""
    return F.struct(
        F.concat(F.col("video_id"), F.lit(id_suffix)).alias("id"),
        F.struct(
            F.col("title"),
            F.col("channel_title").alias("channelTitle"),
            F.col("category_id").cast("string").alias("categoryId"),
            F.col("publish_time").alias("publishedAt"),
            F.split("tags", r"\|").alias("tags"),
            F.col("description"),
            F.struct(F.struct(F.col("thumbnail_link").alias("url")).alias("default")).alias("thumbnails"),
        ).alias("snippet"),
        F.struct(
            F.col("views").cast("string").alias("viewCount"),
            F.col("likes").alias("likeCount"),
            F.when(F.col("dislikes") > 0, F.col("dislikes")).alias("dislikeCount"),
            F.col("comment_count").cast("string").alias("commentCount"),
        ).alias("statistics"),
        F.lit("PT4M").alias("contentDetails"),
    )


def _iso(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ssXXX")


def _metadata(count: int) -> Column:
    return F.struct(
        F.date_format(ARRIVED_AT, "yyyyMMdd_HHmmss").alias("ingestion_id"),
        F.upper(F.trim("region")).alias("region"),
        _iso(F.col(ARRIVED_AT)).alias("ingestion_timestamp"),
        F.lit(count).alias("video_count"),
        F.lit("api").alias("source"),
    )


def region_documents(rows: DataFrame) -> DataFrame:
    """A single-region document for each row, with the row's item and a sibling item."""
    document = F.struct(
        F.lit("videoListResponse").alias("kind"),
        F.array(video_item(), video_item("-b")).alias("items"),
        _metadata(2).alias("_pipeline_metadata"),
    )
    return rows.select(F.to_json(document).alias("document"), ARRIVED_AT)


def single_documents(rows: DataFrame, *kept: str) -> DataFrame:
    """A single-region document for each row, with the row's item alone, and columns to keep beside it."""
    document = F.struct(F.array(video_item()).alias("items"), _metadata(1).alias("_pipeline_metadata"))
    return rows.select(F.to_json(document).alias("document"), ARRIVED_AT, *kept)


def envelope_documents(rows: DataFrame) -> DataFrame:
    """An envelope for each row, with the row's region and a second region."""
    payload = F.struct(F.array(video_item()).alias("items"), _metadata(1).alias("_pipeline_metadata"))
    other = F.struct(F.array(video_item("-z")).alias("items"), _metadata(1).alias("_pipeline_metadata"))
    document = F.struct(
        F.date_format(ARRIVED_AT, "yyyyMMdd_HHmmss").alias("ingestion_id"),
        _iso(F.col(ARRIVED_AT)).alias("fetched_at"),
        F.create_map(F.upper(F.trim("region")), payload, F.lit("ZZ"), other).alias("regions"),
    )
    return rows.select(F.to_json(document).alias("document"), ARRIVED_AT)


def category_documents(spark: SparkSession, sf_dir: str, bare: bool = False) -> DataFrame:
    """A category document for each part: three items of which two share an id.

    ``bare`` writes parts of odd size as one item without an ``items`` list.
    """
    brand = F.substring("p_brand", 7, 10)
    name, kind = F.col("p_name"), F.col("p_type")

    def item(id_: Column, title: Column) -> Column:
        return F.struct(id_.alias("id"), F.struct(title.alias("title")).alias("snippet"))

    stamp = F.timestamp_add("SECOND", F.col("p_partkey").cast("int"), F.lit("2024-01-01").cast("timestamp"))
    listed = F.to_json(
        F.struct(
            F.lit("categoryListResponse").alias("kind"),
            F.array(
                item(brand, name),
                item(F.concat(F.lit("s"), F.col("p_size").cast("string")), kind),
                item(brand, F.concat(name, F.lit(" v2"))),
            ).alias("items"),
            F.struct(_iso(stamp).alias("ingestion_timestamp")).alias("_pipeline_metadata"),
        )
    )
    text = F.when(F.col("p_size") % 2 == 1, F.to_json(item(brand, name))).otherwise(listed) if bare else listed
    key = F.concat(
        F.lit("reference/region%3DR"), (F.col("p_size") % 5).cast("string"), F.lit("/"), F.col("p_partkey"), F.lit(".json")
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_size", text.alias("value"), key.alias("key"), stamp.alias("landed_at")
    )


def nation_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as category reference rows: ids 0 to 24, so that brand 25 has no name."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("snippet.title"),
        F.lit("us").alias("region"),
    )
