"""Language of web pages by Bayesian fusion of evidence.

Four kinds of evidence are added up as log-probabilities for each language:

* the text, by a naive Bayes model of hashed byte trigrams learnt from all labelled documents,
* the language that the markup declares,
* the suffix of the address (``com``, ``de``), and
* the host, whose languages are counted and smoothed by those of its last three labels, these by those of its last two, and
  these by those of all pages. Levels that are the same name, as for ``example.com``, count once.

How far declarations and suffixes can be trusted, and the host's languages, come from counts over all pages, grouped by
declaration, suffix, host and its parents, of the language that the text alone suggests; a page is left out of the counts
that judge it.

Null or empty markup is no text and no declaration; a comment, script or style sheet that is not closed ends with the page; a null or broken address has an empty host and suffix.
Pages without any evidence get the most frequent language. Without labelled documents the language is null.
Repeated rows are judged row by row (each counts). Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmark.llm.common import ready, slices, stored, utf8

BUCKETS = 1 << 14
#: Languages whose trigrams a task counts together; for more, it hands on what it has.
_HELD = 64
#: The text's evidence in units of this many trigrams; neighbouring trigrams are not independent.
TEMPER = 8.0
SMOOTH = 4.0

#: What is not closed goes on to the end of the page, so that no place is read over and over again.
_MARKUP = r"(?s)<!--.*?(?:-->|\z)|(?i:<(script|style)\b[^<>]*>.*?(?:</\1\s*>|\z))|<[^<>]*>"


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of each byte trigram of lower-cased texts; anything but letters counts as one space."""
    code = data.copy()
    upper = (code >= 65) & (code <= 90)
    code[upper] += 32
    code[(code < 97) | ((code > 122) & (code < 128))] = 32
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    if len(code) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    wide = code.astype(np.uint32)
    gram = wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]
    bucket = ((gram * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)
    fits = (row[:-2] == row[2:]) & ~((code[:-2] == 32) & (code[1:-1] == 32))
    return bucket[fits], row[:-2][fits]


def learn_text_model(docs: DataFrame, buckets: int = BUCKETS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, their log shares of documents, and log-probabilities of buckets, from all labelled documents."""
    ready(docs.sparkSession)
    labelled = docs.filter(F.col("lang").isNotNull())
    shares = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    names = [row["lang"] for row in shares]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for name, own in total.items():
                found = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array(found), pa.array(own[found])], ["lang", "bucket", "n"])

        for batch in batches:
            for piece in slices(batch, "text"):
                here, lang = np.unique(np.array(piece.column("lang").to_pylist(), object), return_inverse=True)
                bucket, row = trigrams(*utf8(piece.column("text")))
                cell, n = np.unique(lang[row] * buckets + bucket, return_counts=True)
                edges = np.searchsorted(cell, np.arange(len(here) + 1) * buckets)
                for i, name in enumerate(here):
                    if name not in total:
                        if len(total) == _HELD:
                            yield from rows()
                            total.clear()
                        total[name] = np.zeros(buckets, np.int64)
                    total[name][cell[edges[i] : edges[i + 1]] - i * buckets] += n[edges[i] : edges[i + 1]]
        yield from rows()

    def logs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = np.full(buckets, 0.5)
        total[rows["bucket"]] += rows["n"]
        return pd.DataFrame({"lang": [key[0]], "logs": [np.log(total / total.sum()).tobytes()]})

    counts = labelled.select("lang", "text").mapInArrow(count, "lang string, bucket bigint, n bigint")
    rows = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).groupBy("lang").applyInPandas(logs, "lang string, logs binary")
    # A language whose texts have no trigram has no row: all buckets are alike in it.
    table = np.full((len(names), buckets), -np.log(buckets))
    number = {name: i for i, name in enumerate(names)}
    for row in rows.collect():
        table[number[row["lang"]]] = np.frombuffer(row["logs"])
    prior = np.log([row["count"] for row in shares]) - np.log(max(1, sum(row["count"] for row in shares)))
    return names, np.asarray(prior), table


def page_parts(pages: DataFrame) -> DataFrame:
    """page_id, visible text, declared language, host, site (its last three labels), domain (two) and suffix of every page."""
    html, url = F.coalesce("html", F.lit("")), F.lower(F.coalesce("url", F.lit("")))
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    text = F.regexp_replace(F.regexp_replace(html, _MARKUP, " "), r"&[#\w]+;", " ")
    declared = F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1)
    parts = F.split(host, r"\.")

    def last(labels: int) -> Column:
        return F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - labels + 1), labels), ".")

    return pages.select(
        "page_id",
        text.alias("text"),
        F.lower(declared).alias("declared"),
        host.alias("host"),
        last(3).alias("site"),
        last(2).alias("domain"),
        F.element_at(parts, -1).alias("suffix"),
    )


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, lang, confidence, text_lang, declared, host of every page."""
    names, prior, table = learn_text_model(docs)
    model = docs.sparkSession.sparkContext.broadcast(table)
    kept = ["page_id", "declared", "host", "site", "domain", "suffix"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                bucket, row = trigrams(*utf8(piece.column("text")))
                value = np.stack([np.bincount(row, own[bucket], piece.num_rows) for own in model.value], 1) / TEMPER
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), pa.array(list(value), pa.list_(pa.float64()))], [*kept, "log_text"])

    if not names:
        empty = F.lit(None).cast("string")
        return page_parts(pages).select("page_id", empty.alias("lang"), F.lit(0.0).alias("confidence"), empty.alias("text_lang"), "declared", "host")
    parts = page_parts(pages)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.select(*kept).schema)
    read_pages = parts.select(*kept, "text").mapInArrow(read, f"{kinds}, log_text array<double>")
    start = F.array(*map(F.lit, prior.tolist()))
    own = F.zip_with("log_text", start, lambda t, p: t + p)
    best = F.array_position(own, F.array_max(own)).cast("int") - 1
    read_pages = stored(read_pages.withColumn("guess", best), "pages")

    log = lambda f: F.transform(F.sequence(F.lit(0), F.lit(len(names) - 1)), f)

    def counted(*keys: str) -> DataFrame:
        """For each key, pages by the language their text suggests, as an array."""
        found = read_pages.groupBy(*keys, "guess").agg(F.count("*").cast("double").alias("n"))
        found = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("guess", "n"))).alias("n"))
        return found.select(*keys, log(lambda i: F.coalesce(F.try_element_at("n", i), F.lit(0.0))).alias(f"by_{keys[-1] if keys else 'all'}"))

    rows = read_pages
    for key in ("declared", "suffix", "host", "site", "domain"):
        rows = rows.join(counted(key), key)
    everything = counted().first()
    total = [float(x) for x in everything["by_all"]] if everything["by_all"] and everything["by_all"][0] is not None else [0.0] * len(names)
    pages_of = F.array(*map(F.lit, total))
    every = sum(total)

    def without(counts: str, i):  # noqa: ANN001, ANN202
        return F.get(counts, i) - F.when(i == F.col("guess"), 1.0).otherwise(0.0)

    def size(counts: str):  # noqa: ANN202
        return F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) - 1

    share = lambda i: (F.get(pages_of, i) - F.when(i == F.col("guess"), 1.0).otherwise(0.0) + 1) / (every - 1 + len(names))

    def level(key: str, i, above: Column) -> Column:  # noqa: ANN001
        return (without(f"by_{key}", i) + SMOOTH * above) / (size(f"by_{key}") + SMOOTH)

    def host(i) -> Column:  # noqa: ANN001
        domain = level("domain", i, share(i))
        site = F.when(F.col("site") == F.col("domain"), domain).otherwise(level("site", i, domain))
        return F.when(F.col("host") == F.col("site"), site).otherwise(level("host", i, site))

    # P(declared | language), and of the suffix alike: smoothed by the share of all pages that have it.
    told = lambda c, i: (without(c, i) + SMOOTH * (size(c) + 1) / max(1.0, every)) / (F.get(pages_of, i) + SMOOTH)
    fused = log(
        lambda i: F.get("log_text", i)
        + F.ln(host(i))
        + F.when(F.col("declared") == "", 0.0).otherwise(F.ln(F.greatest(told("by_declared", i), F.lit(1e-6))))
        + F.when(F.col("suffix") == "", 0.0).otherwise(F.ln(F.greatest(told("by_suffix", i), F.lit(1e-6))))
    )
    lang = F.array(*map(F.lit, names))
    top = F.array_max("fused")
    return (
        rows.withColumn("fused", fused)
        .select(
            "page_id",
            F.get(lang, F.array_position("fused", top).cast("int") - 1).alias("lang"),
            (1 / F.aggregate(F.transform("fused", lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)).alias("confidence"),
            F.get(lang, F.col("guess")).alias("text_lang"),
            "declared",
            "host",
        )
    )
