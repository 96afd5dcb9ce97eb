"""Token counts by a two-tier lookup on the map side.

A first pass counts pieces (white space and the word after it) in each task and keeps the most frequent of each
task; the sums of these give a table of at most ``FREQUENT`` pieces, whose token counts are broadcast. The second
pass adds up the counts of every text's pieces; pieces outside the table are encoded by the library and kept in the
worker's cache. No text and no piece of a text is shuffled but the tasks' bounded lists. The table changes speed,
never results.

Strings of special tokens inside a text are found first, as the library does, and count as one token each.
Null and empty texts have no bytes and no tokens. Repeated rows are counted row by row; a null ``doc_id`` stays.
Other columns are ignored.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmark.llm.common import ready, slices
from trendmark.llm.tokens import LONGEST, WORDS_WITH_SPACE, cache

FREQUENT = 1 << 16
FROM_TASK = 1 << 13
_HELD = 1 << 18


def frequent_pieces(docs: DataFrame, most: int = FREQUENT, from_task: int = FROM_TASK) -> list[str]:
    """The most frequent pieces over all documents, by what each task finds most frequent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for piece in slices(batch, "text"):
                for text in piece.column("text").to_pylist():
                    counts.update(WORDS_WITH_SPACE.findall(text or ""))
                if len(counts) > _HELD:
                    counts = Counter(dict(counts.most_common(_HELD // 2)))
        found = [(p, n) for p, n in counts.most_common(from_task) if len(p) <= LONGEST]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], ["piece", "n"])

    sums = docs.select("text").mapInArrow(count, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    return [row["piece"] for row in sums.orderBy(F.desc("n"), "piece").limit(most).collect()]


def special_strings(path: str) -> list[str]:
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file)["added_tokens"]]


def count_tokens(docs: DataFrame, path: str, over: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``over`` tokens) of every row of ``docs``."""
    ready(docs.sparkSession)
    specials = special_strings(path)
    pieces = frequent_pieces(docs)
    frequent = dict(zip(pieces, cache(path, "count", len, {}).encoded(pieces)))
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def tokens(texts: list[str | None]) -> list[int]:
        counts = [0] * len(texts)
        split = []
        for i, text in enumerate(texts):
            parts = [text or ""]
            for special in specials:
                if special in parts[0] or len(parts) > 1:
                    parts = [p for part in parts for p in part.split(special)]
            counts[i] = len(parts) - 1
            split.append([p for part in parts for p in WORDS_WITH_SPACE.findall(part)])
        value = cache(path, "count", len, shared.value).lookup({p for pieces in split for p in pieces})
        return [n + sum(map(value, pieces)) for n, pieces in zip(counts, split)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                n = pa.array(tokens(piece.column("text").to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("n_bytes"), n], ["doc_id", "n_bytes", "n_tokens"])

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")
    rows = docs.select(F.col("doc_id").cast("bigint"), n_bytes, "text").mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return rows.withColumn("over_limit", F.col("n_tokens") > over)
