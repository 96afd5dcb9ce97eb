"""Column-level helpers, all built from Spark's own functions."""

from trendmark.functions.columns import (
    clean_region,
    file_stem,
    item_count,
    partition_stamps,
    parse_timestamp,
    parse_trending_date,
    path_value,
    percent_of,
    region_code,
    url_decoded,
)
from trendmark.functions.structure import field_or, flatten_struct, has_field

__all__ = [
    "clean_region",
    "field_or",
    "file_stem",
    "flatten_struct",
    "has_field",
    "item_count",
    "parse_timestamp",
    "parse_trending_date",
    "partition_stamps",
    "path_value",
    "percent_of",
    "region_code",
    "url_decoded",
]
