"""Sequences of at most ``capacity`` tokens by large-item matching and best fit.

A text is tokenized, ended by an end id and, where it is longer than a sequence, cut into pieces of ``capacity`` tokens and
a rest. Only the number of pieces of each length decides how they are packed, so the plan is made from these at most
``capacity`` counts, whatever the number of documents:

1. *Matching.* Two pieces above a third of the capacity fill a sequence at most. From the longest down, each is matched with
   the longest one that still fits, many pairs of the same two lengths at once. No matching makes more pairs.
2. *Best fit.* The other pieces, from the longest down, go where the least room is left that holds them; a sequence takes
   as many of one length as it holds. New sequences are opened where no room is left.

Sequences that are filled alike are one line of the plan, so its size is bounded by the capacity. Each task numbers its pieces
of a length; with the numbers that earlier tasks gave, a piece has a rank among all of its length, and the
plan gives the rank its sequence and offset.

Null and empty texts have the end id alone, a piece of one token. Every row is packed by itself, also rows that repeat a
``doc_id`` or have none. An empty table gives no piece. Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendmark.llm.common import ready, slices, stored
from trendmark.llm.tokens import word_tokenizer
from trendmark.operators.broadcasting import broadcast_if_small

CAPACITY = 4096

_PIECES = "part int, doc_id bigint, piece int, start bigint, length bigint, nth bigint, ids binary"


def cut(docs: DataFrame, path: str, end: int, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents, with their place among the pieces of their task that are as long."""
    ready(docs.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows in slices(batch, "text"):
                ids, bounds = word_tokenizer(path).ids(rows.column("text"), end)
                size = np.diff(bounds)
                many = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), many)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                length = np.minimum(capacity, size[row] - piece * capacity)
                order = np.argsort(length, kind="stable")
                first = np.searchsorted(length[order], length)
                nth = np.empty(len(row), np.int64)
                nth[order] = np.arange(len(row))
                nth += seen[length] - first
                seen += np.bincount(length, minlength=capacity + 1)
                places = np.append(bounds[row] + piece * capacity, bounds[-1]) * 4
                lists = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
                columns = [np.full(len(row), part, np.int32), rows.column("doc_id").take(pa.array(row)), piece.astype(np.int32), piece * capacity, length, nth]
                yield pa.RecordBatch.from_arrays([*(c if isinstance(c, pa.Array) else pa.array(c) for c in columns), lists.cast(pa.binary())], ["part", "doc_id", "piece", "start", "length", "nth", "ids"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(pieces, _PIECES)


class Plan:
    """For runs of pieces of a length, by rank: their first sequence, how many one holds, and where the first begins in it."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.sequences = capacity, 0
        self.lines: list[tuple[int, int, int, int, int, int]] = []  # length, rank, pieces, sequence, of them in each, offset
        self._rank: dict[int, int] = defaultdict(int)
        self._left: dict[int, list[tuple[int, int]]] = {}  # room left: runs of sequences as (first, how many)
        self._rooms: list[int] = []
        left = {length: n for length, n in counts.items() if n}
        self._match({length: n for length, n in left.items() if 3 * length > capacity})
        for length in sorted((length for length in left if 3 * length <= capacity), reverse=True):
            self._fit(length, left[length])

    def _put(self, length: int, n: int, sequence: int, each: int, offset: int) -> None:
        self.lines.append((length, self._rank[length], n, sequence, each, offset))
        self._rank[length] += n

    def _keep(self, room: int, sequence: int, n: int) -> None:
        if n and room:
            if room not in self._left:
                self._left[room] = []
                insort(self._rooms, room)
            self._left[room].append((sequence, n))

    def _match(self, left: dict[int, int]) -> None:
        lengths = sorted(left)
        for length in reversed(lengths):
            other = bisect_left(lengths, min(length, self.capacity - length) + 1) - 1
            while left[length] and other >= 0:
                partner = lengths[other]
                pairs = left[length] // 2 if partner == length else min(left[length], left[partner])
                if pairs:
                    left[length] -= pairs
                    left[partner] -= pairs
                    self._put(length, pairs, self.sequences, 1, 0)
                    self._put(partner, pairs, self.sequences, 1, length)
                    self._keep(self.capacity - length - partner, self.sequences, pairs)
                    self.sequences += pairs
                other -= 1
            if left[length]:
                self._put(length, left[length], self.sequences, 1, 0)
                self._keep(self.capacity - length, self.sequences, left[length])
                self.sequences += left[length]
                left[length] = 0

    def _fit(self, length: int, n: int) -> None:
        while n:
            at = bisect_left(self._rooms, length)
            if at == len(self._rooms):
                opened = -(-n // (self.capacity // length))
                self._keep(self.capacity, self.sequences, opened)
                self.sequences += opened
                continue
            room = self._rooms.pop(at)
            for sequence, many in self._left.pop(room):
                each = room // length
                full = min(many, n // each)
                if full:
                    self._put(length, full * each, sequence, each, self.capacity - room)
                    self._keep(room - each * length, sequence, full)
                    n -= full * each
                if full < many:
                    if n:
                        self._put(length, n, sequence + full, n, self.capacity - room)
                        self._keep(room - n * length, sequence + full, 1)
                        full, n = full + 1, 0
                    self._keep(room, sequence + full, many - full)


def pack(docs: DataFrame, path: str, end: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset of every piece of every row of ``docs``.

    ``ids`` are little-endian unsigned 32-bit integers, end to end.
    """
    spark = docs.sparkSession
    pieces = stored(cut(docs, path, end, capacity), "pieces", "zstd")
    counts = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")  # a row for each task and length
    plan = Plan({row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    lines = spark.createDataFrame(plan.lines, "length bigint, rank bigint, pieces bigint, sequence bigint, each bigint, first bigint")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    ranked = pieces.join(broadcast_if_small(offsets), ["part", "length"]).withColumn("place", F.col("earlier") + F.col("nth"))
    # The plan's size is bounded by the capacity; the piece's line is the one run of its length that holds its place.
    held = F.col("place").between(F.col("rank"), F.col("rank") + F.col("pieces") - 1)
    within = F.col("place") - F.col("rank")
    return ranked.join(F.broadcast(lines.withColumnRenamed("length", "of")), (F.col("length") == F.col("of")) & held).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids",
        (F.col("sequence") + F.expr("(place - rank) div each")).alias("sequence_id"),
        (F.col("first") + within % F.col("each") * F.col("length")).alias("offset"),
    )
