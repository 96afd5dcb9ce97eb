"""Scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The historical date shape and how it is read.
SHORT_DATE = r"^\d{2}\.\d{2}\.\d{2}$"
SHORT_DATE_FORMAT = "yy.dd.MM"


def clean_region(region: Column) -> Column:
    return F.lower(F.trim(region))


def region_code(region: Column) -> Column:
    """Region as requested from the API: trimmed, upper case."""
    return F.upper(F.trim(region))


def parse_trending_date(text: Column) -> Column:
    """Historical ``yy.dd.MM`` or ISO text to a date; anything else is NULL."""
    historical = F.try_to_date(text, SHORT_DATE_FORMAT)
    return F.when(text.rlike(SHORT_DATE), historical).otherwise(text.try_cast("date"))


def parse_timestamp(value: Column) -> Column:
    """ISO text, date or timestamp to a timestamp; unreadable text is NULL."""
    return value.try_cast("timestamp")


def percent_of(part: Column, whole: Column, digits: int = 4) -> Column:
    """``part`` in per cent of ``whole``; 0.0 where there is no positive whole."""
    share = F.round(part / F.when(whole > 0, whole) * 100, digits)
    return F.when(whole > 0, share).otherwise(F.lit(0.0))


def item_count(items: Column) -> Column:
    """Length of an array; 0 where the array is missing."""
    return F.when(items.isNull(), 0).otherwise(F.size(items))


def partition_stamps(moment: Column) -> dict[str, Column]:
    """The folder and id texts taken from the moment of a fetch."""
    return {
        "date": F.date_format(moment, "yyyy-MM-dd"),
        "hour": F.date_format(moment, "HH"),
        "ingestion_id": F.date_format(moment, "yyyyMMdd_HHmmss"),
    }


def url_decoded(key: Column) -> Column:
    """Object key as stored, from its URL-encoded form; a malformed key stays as it is."""
    return F.coalesce(F.try_url_decode(key), key)


def path_value(path: Column, name: str, default: str = "unknown") -> Column:
    """Value of the first ``name=value`` folder in a path, or the default."""
    found = F.regexp_extract(path, rf"(?:^|/){name}=([^/]*)/", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(default))


def file_stem(path: Column) -> Column:
    """File name without folders and without its last extension."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
