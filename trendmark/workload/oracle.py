"""The SQL each registered query must agree with, in DuckDB's dialect."""

from __future__ import annotations

SNAPSHOT = r"""
snapshot AS (
  SELECT CASE WHEN l_orderkey % 97 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS video_id,
         CASE WHEN l_orderkey % 101 = 0 THEN 'n/a'
              WHEN l_orderkey % 103 = 0 THEN '17.32.13'
              WHEN l_orderkey % 2 = 0 THEN strftime(d, '%y.%d.%m')
              ELSE CAST(d AS VARCHAR) END AS trending_date,
         CASE WHEN l_orderkey % 71 <> 0 THEN p_name END AS title,
         s_name AS channel_title,
         CAST(substring(p_brand, 7) AS BIGINT) AS category_id,
         CAST(d AS VARCHAR) || 'T08:00:00.000Z' AS publish_time,
         replace(p_name, ' ', '|') AS tags,
         CASE WHEN l_orderkey % 41 = 0 THEN 0 ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS views,
         CASE WHEN l_orderkey % 53 <> 0 THEN CAST(l_quantity AS BIGINT) END AS likes,
         CAST(round(l_discount * 100) AS BIGINT) AS dislikes,
         CAST(round(l_tax * 100) AS BIGINT) AS comment_count,
         'https://img.example/' || l_partkey || '.jpg' AS thumbnail_link,
         l_returnflag = 'R' AS comments_disabled,
         l_returnflag = 'A' AS ratings_disabled,
         l_linestatus = 'F' AND l_returnflag = 'N' AS video_error_or_removed,
         p_type || ' "' || p_name || '"' || chr(10) || 'size ' || p_size AS description,
         CASE WHEN l_orderkey % 7 = 0 THEN ' ' || upper(code) || ' ' ELSE code END AS region,
         TIMESTAMP '2024-01-01' + to_days(CAST(l_orderkey % 7 AS INTEGER)) + to_hours(l_linenumber) AS arrived_at
  FROM (SELECT *, CAST(CAST(l_shipdate AS DATE) + INTERVAL 20 YEAR AS DATE) AS d, lower(substring(r_name, 1, 2)) AS code
        FROM lineitem
        JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey)
)"""

COLUMNS = (
    "video_id, trending_date, title, channel_title, category_id, publish_time, tags, views, likes, dislikes, "
    "comment_count, thumbnail_link, comments_disabled, ratings_disabled, video_error_or_removed, description, region"
)

PARSED_DATE = r"""CASE WHEN regexp_full_match(trending_date, '[0-9]{2}\.[0-9]{2}\.[0-9]{2}')
              THEN CAST(try_strptime('20' || trending_date, '%Y.%d.%m') AS DATE)
              ELSE TRY_CAST(trending_date AS DATE) END"""

ORDER = ", ".join(
    f"{name} DESC NULLS LAST"
    for name in (
        "arrived_at, views, likes, dislikes, comment_count, trending_date, title, channel_title, category_id, "
        "publish_time, tags, thumbnail_link, comments_disabled, ratings_disabled, video_error_or_removed, description"
    ).split(", ")
)

# What an API document makes of a snapshot row.
LIVE = r"""
live AS (
  SELECT * REPLACE (strftime(arrived_at, '%y.%d.%m') AS trending_date,
                    upper(trim(region)) AS region,
                    FALSE AS comments_disabled, FALSE AS ratings_disabled, FALSE AS video_error_or_removed,
                    CASE WHEN dislikes > 0 THEN dislikes END AS dislikes)
  FROM snapshot
)"""

# What a text file with a word for zero views makes of it.
HISTORY = "history AS (SELECT * REPLACE (nullif(views, 0) AS views) FROM snapshot)"


def _cleansed(source: str = "snapshot") -> str:
    return f"""
cleansed AS (
  SELECT *, CASE WHEN views > 0 THEN round(CAST(likes AS DOUBLE) / views * 100, 4) ELSE 0.0 END AS like_ratio,
         CASE WHEN views > 0 THEN round(CAST(likes + dislikes + comment_count AS DOUBLE) / views * 100, 4)
              ELSE 0.0 END AS engagement_rate
  FROM (SELECT * REPLACE (lower(trim(region)) AS region, coalesce(views, 0) AS views, coalesce(likes, 0) AS likes,
                          coalesce(dislikes, 0) AS dislikes, coalesce(comment_count, 0) AS comment_count),
               {PARSED_DATE} AS trending_date_parsed
        FROM {source} WHERE video_id IS NOT NULL)
)"""


SILVER = f"""
silver AS (
  SELECT * EXCLUDE (row_num)
  FROM (SELECT *, row_number() OVER (PARTITION BY video_id, region, trending_date_parsed ORDER BY {ORDER}) AS row_num
        FROM cleansed)
  WHERE row_num = 1
)"""

ENRICHED = """
enriched AS (
  SELECT silver.*, coalesce(n_name, 'Unknown') AS category_name
  FROM silver LEFT JOIN nation ON category_id = n_nationkey
)"""

CHANNEL = """
channel AS (
  SELECT channel_title, region,
         CAST(count(DISTINCT video_id) AS BIGINT) AS total_videos,
         CAST(sum(views) AS BIGINT) AS total_views,
         CAST(sum(likes) AS BIGINT) AS total_likes,
         CAST(sum(comment_count) AS BIGINT) AS total_comments,
         round(avg(views) + 1e-9, 4) AS avg_views_per_video,
         round(avg(engagement_rate) + 1e-9, 4) AS avg_engagement_rate,
         max(views) AS peak_views,
         count(trending_date_parsed) AS times_trending,
         min(trending_date_parsed) AS first_trending,
         max(trending_date_parsed) AS last_trending,
         array_to_string(list_sort(list(DISTINCT category_name)), '|') AS categories
  FROM enriched GROUP BY channel_title, region
)"""

CATEGORY = """
category AS (
  SELECT *, round(CAST(total_views AS DOUBLE)
                  / nullif(sum(total_views) OVER (PARTITION BY region, trending_date_parsed), 0) * 100, 2)
            AS view_share_pct
  FROM (SELECT category_name, category_id, region, trending_date_parsed,
               count(video_id) AS video_count,
               CAST(sum(views) AS BIGINT) AS total_views,
               CAST(sum(likes) AS BIGINT) AS total_likes,
               CAST(sum(comment_count) AS BIGINT) AS total_comments,
               round(avg(engagement_rate) + 1e-9, 4) AS avg_engagement_rate,
               count(DISTINCT channel_title) AS unique_channels
        FROM enriched GROUP BY ALL)
)"""

TRENDING = """
SELECT region, trending_date_parsed,
       count(video_id) AS total_videos,
       CAST(sum(views) AS BIGINT) AS total_views,
       CAST(sum(likes) AS BIGINT) AS total_likes,
       CAST(sum(dislikes) AS BIGINT) AS total_dislikes,
       CAST(sum(comment_count) AS BIGINT) AS total_comments,
       round(avg(views) + 1e-9, 4) AS avg_views_per_video,
       round(avg(like_ratio) + 1e-9, 4) AS avg_like_ratio,
       round(avg(engagement_rate) + 1e-9, 4) AS avg_engagement_rate,
       max(views) AS max_views,
       count(DISTINCT channel_title) AS unique_channels,
       count(DISTINCT category_id) AS unique_categories
FROM silver GROUP BY region, trending_date_parsed"""

# Items of the category documents: three for each part, of which the first and the last share an id.
CATEGORY_ITEMS = """
items AS (
  SELECT p_partkey, p_size, 'R' || (p_size % 5) AS region,
         'reference/region=R' || (p_size % 5) || '/' || p_partkey || '.json' AS source_file,
         unnest([substring(p_brand, 7), 's' || p_size, substring(p_brand, 7)]) AS id,
         unnest([p_name, p_type, p_name || ' v2']) AS snippet_title,
         unnest([0, 1, 2]) AS position
  FROM part
)"""

LAST_ITEMS = """
last_items AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_file, id ORDER BY position DESC) AS nth FROM items)
  WHERE nth = 1
)"""

SILVER_COLUMNS = f"{COLUMNS}, trending_date_parsed, like_ratio, engagement_rate"
KEY = "video_id, region, trending_date_parsed"


def _with(body: str, *parts: str) -> str:
    return f"WITH {','.join(parts)}\n{body}"


def _snapshot(body: str, *parts: str) -> str:
    return _with(body, SNAPSHOT, *parts)


def _cleansed_rows(body: str, *parts: str) -> str:
    return _snapshot(body, _cleansed(), *parts)


def _silver(body: str, *parts: str) -> str:
    return _cleansed_rows(body, SILVER, *parts)


def _enriched(body: str, *parts: str) -> str:
    return _silver(body, ENRICHED, *parts)


def _live_silver(body: str) -> str:
    return _snapshot(body, LIVE, _cleansed("live"), SILVER)


_NULLS = [
    ("video_id", "video_id"),
    ("title", "title"),
    ("channel_title", "channel_title"),
    ("views", "views"),
]


def _null_pct(columns: list[tuple[str, str]], threshold: str) -> str:
    rows = [
        f"""SELECT 'null_pct' AS "check", 'clean_statistics' AS "table", '{name}' AS "column",
        round(count(*) FILTER ({column} IS NULL) * 100.0 / count(*), 2) AS value,
        CAST({threshold} AS DOUBLE) AS threshold,
        count(*) FILTER ({column} IS NULL) * 100.0 / count(*) <= {threshold} AS passed FROM snapshot"""
        for name, column in columns
    ]
    missing = f"""SELECT 'null_pct', 'clean_statistics', 'region', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), FALSE"""
    return "\nUNION ALL ".join([*rows, missing])


_STATISTICS_CHECKS = """
statistics_checks AS (
  SELECT 'row_count' AS "check", 'clean_statistics' AS "table", CAST(NULL AS VARCHAR) AS "column", count(*) >= 10 AS passed
  FROM silver
  UNION ALL SELECT 'null_pct', 'clean_statistics', 'video_id', count(*) FILTER (video_id IS NULL) * 100.0 / count(*) <= 5 FROM silver
  UNION ALL SELECT 'null_pct', 'clean_statistics', 'title', count(*) FILTER (title IS NULL) * 100.0 / count(*) <= 5 FROM silver
  UNION ALL SELECT 'null_pct', 'clean_statistics', 'channel_title', count(*) FILTER (channel_title IS NULL) * 100.0 / count(*) <= 5 FROM silver
  UNION ALL SELECT 'null_pct', 'clean_statistics', 'views', count(*) FILTER (views IS NULL) * 100.0 / count(*) <= 5 FROM silver
  UNION ALL SELECT 'null_pct', 'clean_statistics', 'region', count(*) FILTER (region IS NULL) * 100.0 / count(*) <= 5 FROM silver
  UNION ALL SELECT 'schema', 'clean_statistics', NULL, TRUE
  UNION ALL SELECT 'value_range', 'clean_statistics', 'views',
    count(*) FILTER (views - {shift} < 0 OR views - {shift} > 50000000000) = 0 FROM silver
  UNION ALL SELECT 'freshness', 'clean_statistics', '_processed_at', TRUE
)"""

_REFERENCE_CHECKS = """
reference_checks AS (
  SELECT 'row_count' AS "check", 'clean_reference_data' AS "table", CAST(NULL AS VARCHAR) AS "column", count(*) >= 10 AS passed
  FROM items
  UNION ALL SELECT 'null_pct', 'clean_reference_data', 'id', count(*) FILTER (id IS NULL) * 100.0 / count(*) <= 5 FROM items
  UNION ALL SELECT 'null_pct', 'clean_reference_data', 'region', count(*) FILTER (region IS NULL) * 100.0 / count(*) <= 5 FROM items
  UNION ALL SELECT 'schema', 'clean_reference_data', NULL, TRUE
  UNION ALL SELECT 'freshness', 'clean_reference_data', '_ingestion_timestamp', FALSE
)"""

_ALL_CHECKS = """
checks AS (SELECT * FROM statistics_checks UNION ALL SELECT * FROM reference_checks)"""


def _all_checks(body: str) -> str:
    return _silver(body, CATEGORY_ITEMS, _STATISTICS_CHECKS.format(shift=5000), _REFERENCE_CHECKS, _ALL_CHECKS)


_SHAPE = "SELECT '{shape}' AS shape, {name} AS category_name, count(*) AS cnt FROM cleansed {join} GROUP BY 2"
_NAMED = "coalesce(n_name, 'Unknown')"
_JOIN = "LEFT JOIN nation ON category_id = n_nationkey"

GOLD_CHANNEL = _enriched(
    """SELECT *, CAST(row_number() OVER (PARTITION BY region ORDER BY total_views DESC, channel_title NULLS LAST)
    AS INTEGER) AS rank_in_region FROM channel""",
    CHANNEL,
)
GOLD_CATEGORY = _enriched("SELECT * FROM category", CATEGORY)

ORACLE: dict[str, str] = {
    # Sources
    "csv_scan_roundtrip": _snapshot(f"SELECT * EXCLUDE (arrived_at) REPLACE (lower(trim(region)) AS region) FROM snapshot"),
    "csv_scan_drift": _snapshot(
        """SELECT * EXCLUDE (arrived_at) REPLACE (lower(trim(region)) AS region,
        CASE WHEN lower(trim(region)) <> 'eu' THEN likes END AS likes) FROM snapshot"""
    ),
    "json_scan_roundtrip": _snapshot(f"SELECT {COLUMNS} FROM live", LIVE),
    "json_items_explode": _snapshot(
        """SELECT video_id || suffix AS video_id, title, upper(trim(region)) AS region, position
        FROM snapshot CROSS JOIN (VALUES ('', 0), ('-b', 1)) AS siblings(suffix, position)"""
    ),
    "json_envelope_flatten": _snapshot(
        """SELECT video_id, upper(trim(region)) AS region, CAST(views AS VARCHAR) AS view_text,
               strftime(arrived_at, '%Y-%m-%d %H:%M:%S') AS arrived_at FROM snapshot
        UNION ALL
        SELECT video_id || '-z', 'ZZ', CAST(views AS VARCHAR), strftime(arrived_at, '%Y-%m-%d %H:%M:%S') FROM snapshot"""
    ),
    "category_flatten": _with("SELECT id, snippet_title, region, source_file FROM items", CATEGORY_ITEMS),
    "category_fallback": _with(
        "SELECT id, snippet_title, region, source_file FROM items WHERE p_size % 2 = 0 OR position = 0", CATEGORY_ITEMS
    ),
    "csv_glob_scan": """SELECT l_linestatus, l_returnflag, 2 * count(*) AS rows,
        round(2 * sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY l_linestatus, l_returnflag""",
    "csv_infer": """SELECT p_partkey, p_name, p_retailprice,
        'p_partkey:int|p_name:string|p_brand:string|p_type:string|p_size:int|p_retailprice:double' AS types FROM part""",
    "path_region_extract": _snapshot(
        """SELECT 'raw/' || CASE WHEN views > 0 THEN 'region=' || lower(trim(region)) || '/' ELSE '' END
               || 'date=' || strftime(arrived_at, '%Y-%m-%d') || '/hour=' || strftime(arrived_at, '%H') || '/x.json' AS path,
               CASE WHEN views > 0 THEN lower(trim(region)) ELSE 'unknown' END AS region,
               strftime(arrived_at, '%Y-%m-%d') AS date, strftime(arrived_at, '%H') AS hour FROM snapshot"""
    ),
    "region_in_filter": _cleansed_rows(f"SELECT {KEY}, views FROM cleansed WHERE region IN ('eu', 'af')"),
    "source_key_decode": _snapshot(
        """SELECT 'raw%2Fregion%3D' || lower(trim(region)) || '%2F' || replace(tags, '|', '+') || '.json' AS encoded,
               'raw/region=' || lower(trim(region)) || '/' || replace(tags, '|', ' ') || '.json' AS decoded FROM snapshot"""
    ),
    "dq_sample_limit": _cleansed_rows(
        """SELECT 'row_count' AS "check", 'clean_statistics' AS "table",
        CAST(least(count(*), 10000) AS DOUBLE) AS value, least(count(*), 10000) >= 10 AS passed FROM cleansed"""
    ),
    # Sinks
    "sink_partitioned_parquet": _silver(f"SELECT {SILVER_COLUMNS} FROM silver"),
    "sink_dynamic_overwrite": _cleansed_rows(
        f"SELECT {KEY}, CASE WHEN region = 'eu' THEN 2 * views ELSE views END AS views, likes FROM cleansed"
    ),
    "schema_evolution_union": _cleansed_rows(
        "SELECT video_id, region, views, CASE WHEN region NOT IN ('af', 'am') THEN likes END AS likes FROM cleansed"
    ),
    "bronze_json_sink": _snapshot(
        """SELECT strftime(arrived_at, '%Y-%m-%d') AS date, strftime(arrived_at, '%H') AS hour,
               strftime(arrived_at, '%Y%m%d_%H%M%S') AS ingestion_id,
               strftime(arrived_at, '%Y-%m-%dT%H:%M:%SZ') AS fetched_at, count(*) AS documents
        FROM snapshot GROUP BY ALL"""
    ),
    "bronze_json_same_second": _snapshot(
        "SELECT strftime(arrived_at, '%Y%m%d_%H%M%S') AS ingestion_id, count(*) AS documents FROM snapshot GROUP BY ALL"
    ),
    "csv_to_parquet": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
        CAST(NULL AS VARCHAR) AS corrupt FROM orders""",
    "conversion_manifest": """SELECT 'orders' AS layout, 'converted' AS status, count(*) AS rows, TRUE AS one_output_each FROM orders
        UNION ALL SELECT 'customer', 'converted', count(*), TRUE FROM customer UNION ALL SELECT 'broken', 'failed', 0, TRUE""",
    # Projections and filters
    "normalize_csv": _snapshot(f"SELECT {COLUMNS} FROM history", HISTORY),
    "normalize_json": _snapshot(f"SELECT {COLUMNS} FROM live", LIVE),
    "optional_column": _snapshot(
        """SELECT shape, CASE WHEN shape = 'absent' THEN 'none' ELSE title END AS title, count(*) AS cnt
        FROM snapshot CROSS JOIN (VALUES ('nested'), ('dotted'), ('doubled'), ('flat'), ('absent')) AS shapes(shape)
        GROUP BY 1, 2"""
    ),
    "filter_null_key": _snapshot("SELECT video_id, region, trending_date, views FROM snapshot WHERE video_id IS NOT NULL"),
    "region_canonical": _snapshot(
        "SELECT region AS raw, lower(trim(region)) AS region, count(*) AS cnt FROM snapshot GROUP BY 1, 2"
    ),
    "parse_trending_date": _snapshot(
        f"SELECT trending_date, {PARSED_DATE} AS trending_date_parsed, count(*) AS cnt FROM snapshot GROUP BY 1, 2"
    ),
    "fill_null_counters": _snapshot(
        """SELECT video_id, trending_date, coalesce(views, 0) AS views, coalesce(likes, 0) AS likes,
        coalesce(dislikes, 0) AS dislikes, coalesce(comment_count, 0) AS comment_count FROM snapshot"""
    ),
    "derive_like_ratio": _cleansed_rows(f"SELECT {KEY}, views, likes, like_ratio FROM cleansed"),
    "derive_engagement_rate": _cleansed_rows(f"SELECT {KEY}, views, engagement_rate FROM cleansed"),
    "audit_columns": _snapshot(
        """SELECT channel_title, '2024-02-01 00:00:00' AS processed_at, '2024-02-01T00:00:00' AS ingestion_timestamp,
        'medallion' AS job_name, 'raw/a.json' AS source_file, count(*) AS cnt FROM snapshot GROUP BY ALL"""
    ),
    "region_code_upper": _snapshot("SELECT upper(trim(region)) AS region_code, count(*) AS cnt FROM snapshot GROUP BY 1"),
    "items_size": """SELECT 'reference/region=R' || (p_size % 5) || '/' || p_partkey || '.json' AS source_file,
        CASE WHEN p_size % 2 = 1 THEN 0 ELSE 3 END AS item_count FROM part""",
    "partition_stamps": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour,
        strftime(ts, '%Y%m%d_%H%M%S') AS ingestion_id FROM events""",
    # Joins
    "lookup_join": _cleansed_rows(
        f"SELECT category_id, {_NAMED} AS category_name, {KEY}, views FROM cleansed {_JOIN}"
    ),
    "lookup_shapes": _cleansed_rows(
        "\nUNION ALL ".join(
            [
                *[_SHAPE.format(shape=shape, name=_NAMED, join=_JOIN) for shape in ("dotted", "nested", "flat")],
                _SHAPE.format(shape="neither", name="'Unknown'", join=""),
            ]
        )
    ),
    "category_lookup": """SELECT category_id, category_name FROM (
        SELECT CAST(substring(p_brand, 7) AS BIGINT) AS category_id, p_type || ' ' || p_name AS category_name,
               row_number() OVER (PARTITION BY p_brand ORDER BY p_size % 5, p_type || ' ' || p_name) AS nth FROM part)
        WHERE nth = 1""",
    # Aggregates
    "gold_trending": _silver(TRENDING),
    "gold_channel": GOLD_CHANNEL,
    "gold_category": GOLD_CATEGORY,
    "gold_without_reference": _silver(
        "SELECT * FROM category", "enriched AS (SELECT *, 'Unknown' AS category_name FROM silver)", CATEGORY
    ),
    "approx_unique_channels": _cleansed_rows(
        """SELECT region, trending_date_parsed, count(DISTINCT channel_title) AS unique_channels, TRUE AS close
        FROM cleansed GROUP BY region, trending_date_parsed"""
    ),
    "channel_categories": _enriched(
        """SELECT channel_title, region, array_to_string(list_sort(list(DISTINCT category_name)), '|') AS categories
        FROM enriched GROUP BY channel_title, region"""
    ),
    "stage_row_counts": _silver(
        """SELECT 'read' AS stage, count(*) AS rows FROM snapshot
        UNION ALL SELECT 'cleansed', count(*) FROM cleansed UNION ALL SELECT 'deduplicated', count(*) FROM silver"""
    ),
    "inline_null_counts": _snapshot(
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS column_name, count(*) FILTER ({name} IS NULL) AS null_count FROM snapshot"
            for name in ("video_id", "title", "channel_title", "views", "likes")
        )
    ),
    "inline_negative_views": _snapshot("SELECT count(*) FILTER (views - 5000 < 0) AS negative_views FROM snapshot"),
    "rows_per_region": _silver("SELECT region, count(*) AS cnt FROM silver GROUP BY region"),
    "rows_per_source": _with(
        "SELECT source_file, region, count(*) AS cnt FROM last_items GROUP BY 1, 2", CATEGORY_ITEMS, LAST_ITEMS
    ),
    "ingestion_summary": _snapshot(
        """SELECT ingestion_id, region, video_count IS NOT NULL AS succeeded, coalesce(video_count, 0) AS video_count
        FROM (SELECT DISTINCT strftime(arrived_at, '%Y%m%d_%H%M%S') AS ingestion_id FROM snapshot)
        CROSS JOIN (VALUES ('AF'), ('AM'), ('AS'), ('EU'), ('MI'), ('XX')) AS expected(region)
        LEFT JOIN (SELECT strftime(arrived_at, '%Y%m%d_%H%M%S') AS ingestion_id, upper(trim(region)) AS region,
                          count(*) AS video_count FROM snapshot GROUP BY 1, 2) USING (ingestion_id, region)"""
    ),
    # Windows, order, sets
    "silver_dedup": _silver(f"SELECT {SILVER_COLUMNS} FROM silver"),
    "channel_rank": _silver(
        """SELECT channel_title, region, total_views,
               CAST(row_number() OVER (PARTITION BY region ORDER BY total_views DESC, channel_title) AS INTEGER)
               AS rank_in_region
        FROM (SELECT channel_title, region, CAST(sum(views) AS BIGINT) AS total_views FROM silver GROUP BY 1, 2)"""
    ),
    "category_view_share": _enriched(
        "SELECT category_name, category_id, region, trending_date_parsed, total_views, view_share_pct FROM category",
        CATEGORY,
    ),
    "top_channels": _enriched(
        """SELECT channel_title, total_views, times_trending FROM channel WHERE region = 'eu'
        ORDER BY total_views DESC, channel_title LIMIT 10""",
        CHANNEL,
    ),
    "top_categories": _enriched(
        """SELECT category_name, view_share_pct, total_views FROM category WHERE region = 'am'
        ORDER BY view_share_pct DESC, category_name""",
        CATEGORY,
    ),
    "union_sources": _snapshot(
        """SELECT video_id, trending_date, title, views, tags, region FROM history
        UNION ALL SELECT video_id, trending_date, title, views, tags, region FROM live""",
        HISTORY,
        LIVE,
    ),
    "union_empty_side": _snapshot("SELECT video_id, trending_date, title, region FROM snapshot"),
    "category_keep_last": _with(
        "SELECT id, snippet_title, region, source_file FROM last_items", CATEGORY_ITEMS, LAST_ITEMS
    ),
    "category_validation": """SELECT rule, CAST(count(p_size) * each AS DOUBLE) AS value, count(p_size) = 0 OR NOT refuses AS passed,
        CASE WHEN refuses THEN count(p_size) * each ELSE 0 END AS refused
        FROM (VALUES ('unreadable', TRUE, 1, 4), ('no_items', TRUE, 1, 3), ('no_id', TRUE, 3, 2), ('no_title', FALSE, 3, 5),
                     ('repeated_id', FALSE, 1, NULL)) AS rules(rule, refuses, each, size)
        LEFT JOIN part ON p_size = size OR (size IS NULL AND p_size NOT IN (2, 3, 4))
        GROUP BY rule, refuses, each""",
    # Quality
    "dq_row_count": _silver(
        """SELECT 'row_count' AS "check", 'clean_statistics' AS "table", CAST(count(*) AS DOUBLE) AS value,
        CAST(10 AS DOUBLE) AS threshold, count(*) >= 10 AS passed FROM silver"""
    ),
    "dq_null_pct": _snapshot(_null_pct(_NULLS, "1.0")),
    "dq_schema": _snapshot(
        """SELECT 'row_count' AS "check", 'clean_statistics' AS "table", count(*) >= 10 AS passed,
        CAST(NULL AS VARCHAR) AS missing FROM snapshot
        UNION ALL SELECT 'schema', 'clean_statistics', FALSE, 'region|title'"""
    ),
    "dq_value_range": _snapshot(
        """SELECT 'value_range' AS "check", 'clean_statistics' AS "table", 'views' AS "column",
        count(*) FILTER (views <= 100000 AND views - 5000 < 0) AS negative_count,
        count(*) FILTER (views > 100000) AS extreme_count,
        count(*) FILTER (views > 100000 OR views - 5000 < 0) = 0 AS passed FROM snapshot"""
    ),
    "dq_freshness": """WITH latest AS (SELECT max(ts) AS ts FROM events)
        SELECT 'freshness' AS "check", name AS "table",
               CASE WHEN name IN ('live', 'text') THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS latest_record,
               CASE WHEN name <> 'none' THEN '2024-01-30 00:00:00' END AS cutoff,
               name IN ('unreadable', 'none') OR ts >= TIMESTAMP '2024-01-30' AS passed
        FROM latest CROSS JOIN (VALUES ('live'), ('text'), ('unreadable'), ('none')) AS tables(name)""",
    "dq_read_table": _silver(
        """SELECT * FROM statistics_checks
        UNION ALL SELECT 'read_table', 'clean_reference_data', NULL, FALSE""",
        _STATISTICS_CHECKS.format(shift=0),
    ),
    "dq_summary": _all_checks(
        """SELECT bool_and(passed) AS quality_passed, CAST(count(*) FILTER (passed) AS INTEGER) AS checks_passed,
        CAST(count(*) AS INTEGER) AS checks_total, CAST(count(*) AS INTEGER) AS details FROM checks"""
    ),
    "dq_failures": _all_checks('SELECT "check", "table", "column" FROM checks WHERE NOT passed'),
    "gated_gold": _silver(TRENDING),
    "gated_gold_channel": GOLD_CHANNEL,
    "gated_gold_category": GOLD_CATEGORY,
    # Incremental
    "incremental_ingest": _live_silver(f"SELECT {SILVER_COLUMNS} FROM silver"),
    "incremental_upsert": _live_silver(f"SELECT {SILVER_COLUMNS} FROM silver"),
    "incremental_gold": _snapshot(
        f"""SELECT 'channel' AS "table", region, channel_title AS name, CAST(NULL AS DATE) AS day, total_views, total_videos AS videos,
            CAST(row_number() OVER (PARTITION BY region ORDER BY total_views DESC, channel_title NULLS LAST) AS DOUBLE) AS place
        FROM channel
        UNION ALL SELECT 'category', region, category_name, trending_date_parsed, total_views, video_count, view_share_pct FROM category
        UNION ALL SELECT 'trending', region, NULL, trending_date_parsed, total_views, total_videos, CAST(unique_channels AS DOUBLE)
        FROM ({TRENDING})""",
        LIVE,
        _cleansed("live"),
        SILVER,
        ENRICHED,
        CHANNEL,
        CATEGORY,
    ),
    "incremental_reference": _with(
        """SELECT lower(region) AS region, id, snippet_title FROM last_items
        WHERE p_partkey IN (SELECT max(p_partkey) FROM part WHERE p_size <> 1 GROUP BY p_size % 5)
        UNION ALL SELECT 'quarantine', CAST(count(*) AS VARCHAR), NULL FROM part WHERE p_size = 1""",
        CATEGORY_ITEMS,
        LAST_ITEMS,
    ),
    "incremental_quarantine": _snapshot(
        """SELECT region, trending_date_parsed, count(*) AS cnt FROM silver GROUP BY ALL
        UNION ALL SELECT 'quarantine', NULL, count(*) FROM snapshot WHERE hour(arrived_at) = 2""",
        LIVE,
        "whole AS (SELECT * FROM live WHERE hour(arrived_at) <> 2)",
        _cleansed("whole"),
        SILVER,
    ),
    "incremental_late_arrivals": _snapshot(
        f"""SELECT {KEY}, strftime(min(arrived_at), '%Y-%m-%d %H:%M:%S') AS arrived_at,
        min(arrived_at) < (SELECT max(arrived_at) FROM live) - INTERVAL 72 HOUR AS late FROM cleansed GROUP BY {KEY}""",
        LIVE,
        _cleansed("live"),
    ),
    "incremental_csv": _snapshot("SELECT * EXCLUDE (arrived_at) REPLACE (lower(trim(region)) AS region) FROM snapshot"),
    "incremental_csv_drift": _snapshot(
        """SELECT * EXCLUDE (arrived_at) REPLACE (lower(trim(region)) AS region,
        CASE WHEN lower(trim(region)) <> 'eu' THEN likes END AS likes) FROM snapshot"""
    ),
    "incremental_dedup_bounded": _snapshot(f"SELECT DISTINCT {KEY} FROM cleansed", LIVE, _cleansed("live")),
}
