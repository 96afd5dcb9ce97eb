"""Validation of category documents: what is refused, what is only reported, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmark.config import REFERENCE
from trendmark.operators.reference import REPEATED, category_items, numbered_categories
from trendmark.schemas import CHECK_ROW, CORRUPT
from trendmark.sources.documents import split_corrupt

#: Why a document or an item is refused; it goes to quarantine.
REFUSED = ("unreadable", "no_items", "no_id")
#: What is reported only: the item is kept, or an item with its id is.
REPORTED = ("no_title", "repeated_id")


def has_content() -> Column:
    """False for documents that hold no category at all."""
    return F.coalesce(F.size("items") > 0, F.lit(False)) | F.col("regions").isNotNull() | F.col("id").isNotNull()


def _missing(name: str) -> Column:
    return F.coalesce(F.trim(F.col(f"`{name}`")), F.lit("")) == ""


def item_problems(items: DataFrame) -> DataFrame:
    """``items`` with ``_problems``: the rules that each item breaks."""
    broken = {
        "no_id": _missing("id"),
        "no_title": _missing("snippet.title"),
        "repeated_id": ~_missing("id") & F.col(REPEATED),
    }
    listed = F.array_compact(F.array(*[F.when(condition, F.lit(rule)) for rule, condition in broken.items()]))
    return numbered_categories(items).withColumn("_problems", listed).drop(REPEATED)


def judged_categories(documents: DataFrame) -> DataFrame:
    """``rule``, source, region, id and the text of everything that breaks a rule, one row for each rule broken."""
    readable, corrupt = split_corrupt(documents)
    unreadable = corrupt.select(
        F.lit("unreadable").alias("rule"), "_source_file", F.lit(None).cast("string").alias("region"), F.lit(None).cast("string").alias("id"),
        F.col(CORRUPT).alias("detail"),
    )
    empty = readable.filter(~has_content()).select(
        F.lit("no_items").alias("rule"), "_source_file", F.lit(None).cast("string").alias("region"), F.lit(None).cast("string").alias("id"),
        F.lit(None).cast("string").alias("detail"),
    )
    problems = item_problems(category_items(readable.filter(has_content())))
    broken = problems.select(
        F.explode("_problems").alias("rule"), "_source_file", "region", "id",
        F.to_json(F.struct(F.col("id"), F.col("`snippet.title`").alias("title"), F.col("_position").alias("position"))).alias("detail"),
    )
    return unreadable.unionByName(empty).unionByName(broken)


def quarantined_categories(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("rule").isin(*REFUSED))


def category_checks(judged: DataFrame) -> DataFrame:
    """One check row for each rule: how often it is broken. It fails where something was refused."""
    counts = judged.groupBy("rule").agg(F.count("*").alias("found"))
    rules = judged.sparkSession.createDataFrame([(r, r in REFUSED) for r in (*REFUSED, *REPORTED)], "rule string, refuses boolean")
    found = F.coalesce("found", F.lit(0))
    stated = {
        "check": F.lit("category_rule"),
        "table": F.lit(REFERENCE),
        "column": F.col("rule"),
        "value": found.cast("double"),
        "threshold": F.lit(0.0),
        "passed": ~F.col("refuses") | (found == 0),
        "message": F.format_string("%s: %d", F.col("rule"), found),
    }
    return rules.join(counts, "rule", "left").select(
        *[stated.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CHECK_ROW.fields]
    )
