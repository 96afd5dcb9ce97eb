"""Benchmark decontamination as a prefix-filtered set join.

An item's windows are its runs of ``size`` words (a shorter item is one window). A window occurs in a
document only where its rarest word occurs, so that word, by counts over all documents, is the necessary
prefix: documents are joined with windows on it alone. The word's place in the window gives the place of
the whole window; windows that would begin before or end after the document are dropped by position and
length, and the rest is verified word by word.

Windows are shipped to tasks in blocks of at most ``WINDOWS``, which bounds what is broadcast; a larger
benchmark is searched block after block, and the hit places of a row, which has a key of its own there, are united.

Words are compared by 64-bit hashes. Null or wordless documents have no words and no hits; null, empty or
wordless items have no window. Every row is judged by itself, also rows that repeat a doc_id or have none.
An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmark.llm.common import BY_SYMBOL, ready, slices, stored, utf8, word_hashes
from trendmark.operators.broadcasting import broadcast_if_small

SIZE = 13
WINDOWS = 200_000
_LOW = (1 << 16) - 1


def _filter(keys: np.ndarray) -> np.ndarray:
    """Which low bits occur among the keys: a cheap first look."""
    seen = np.zeros(_LOW + 1, bool)
    seen[(keys & np.uint64(_LOW)).astype(np.int64)] = True
    return seen


def _find(keys: np.ndarray, seen: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of words that are among sorted keys, and which key each is."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places = np.flatnonzero(seen[(words & np.uint64(_LOW)).astype(np.int64)])
    which = np.minimum(np.searchsorted(keys, words[places]), len(keys) - 1)
    right = keys[which] == words[places]
    return places[right], which[right]


def item_words(benchmark: DataFrame) -> DataFrame:
    """item_id and the item's word hashes, for items that have words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, bounds = word_hashes(*utf8(batch.column("text")), BY_SYMBOL)
            rows = [words[a:b].view(np.int64) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(rows, pa.list_(pa.int64()))], ["item_id", "words"])

    return benchmark.select(F.col("item_id").cast("string"), "text").mapInArrow(
        hashed, "item_id string, words array<bigint>"
    ).filter("size(words) > 0")


def word_counts(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Occurrences in all documents of each word of a sorted, bounded vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shared.value
        seen, total = _filter(keys), np.zeros(len(keys), np.int64)
        for batch in batches:
            for piece in slices(batch, "text"):
                words, _ = word_hashes(*utf8(piece.column("text")), BY_SYMBOL)
                total += np.bincount(_find(keys, seen, words)[1], minlength=len(keys))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["word", "n"])

    rows = docs.select("text").mapInArrow(counted, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(vocabulary), np.int64)
    out[rows["word"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


class Windows:
    """A block of windows: each with its words, its rarest word and where that stands, and its items."""

    def __init__(self, items: list[tuple[str, np.ndarray]], size: int, count: dict[int, int]):
        place: dict[bytes, int] = {}
        self.words: list[np.ndarray] = []
        self.items: list[list[str]] = []
        for item, words in items:
            for start in range(max(1, len(words) - size + 1)):
                window = words[start : start + size]
                number = place.setdefault(window.tobytes(), len(self.words))
                if number == len(self.words):
                    self.words.append(window)
                    self.items.append([])
                if item not in self.items[number][-1:]:
                    self.items[number].append(item)
        rarest = [min(range(len(w)), key=lambda i: (count[int(w[i])], int(w[i]))) for w in self.words]
        anchors = np.array([w[i] for w, i in zip(self.words, rarest)], np.uint64)
        order = np.argsort(anchors, kind="stable")
        self.words = [self.words[i] for i in order]
        self.items = [self.items[i] for i in order]
        self.length = np.array([len(w) for w in self.words], np.int64)
        self.before = np.array(rarest, np.int64)[order]
        self.keys, self.first, self.many = np.unique(anchors[order], return_index=True, return_counts=True)
        self.padded = np.zeros((len(self.words), size), np.uint64)
        for i, w in enumerate(self.words):
            self.padded[i, : len(w)] = w

    def occurrences(self, words: np.ndarray, bounds: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where windows begin in the words of several documents, and which windows they are."""
        places, which = _find(self.keys, seen, words)
        many = self.many[which]
        window = np.repeat(self.first[which] - np.cumsum(many) + many, many) + np.arange(many.sum())
        start = np.repeat(places, many) - self.before[window]
        row = np.searchsorted(bounds, np.repeat(places, many), side="right") - 1
        fits = (start >= bounds[row]) & (start + self.length[window] <= bounds[row + 1])
        start, window = start[fits], window[fits]
        for k in range(self.padded.shape[1]):
            inside = self.length[window] > k
            same = ~inside
            same[inside] = words[start[inside] + k] == self.padded[window[inside], k]
            start, window = start[same], window[same]
        return start, window


def _hits(piece: pa.RecordBatch, windows: Windows, seen: np.ndarray) -> tuple[np.ndarray, list[list], list[set]]:
    """Of each row: its number of words, its spans of hit words and the items found."""
    words, bounds = word_hashes(*utf8(piece.column("text")), BY_SYMBOL)
    start, window = windows.occurrences(words, bounds, seen)
    spans: list[list] = [[] for _ in range(piece.num_rows)]
    items: list[set] = [set() for _ in range(piece.num_rows)]
    order = np.argsort(start, kind="stable")
    start, window = start[order], window[order]
    rows = np.searchsorted(bounds, start, side="right") - 1
    for row, a, w in zip(rows.tolist(), (start - bounds[rows]).tolist(), window.tolist()):
        b = a + int(windows.length[w])
        if spans[row] and a <= spans[row][-1]["b"]:
            spans[row][-1]["b"] = max(b, spans[row][-1]["b"])
        else:
            spans[row].append({"a": a, "b": b})
        items[row].update(windows.items[w])
    return np.diff(bounds), spans, items


def _searched(docs: DataFrame, block: Windows) -> DataFrame:
    """The columns of ``docs`` but its text, and n_words, spans, items of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    kept = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"{c} bigint" for c in kept) + ", n_words bigint, spans array<struct<a: bigint, b: bigint>>, items array<string>"
    kinds = [pa.int64(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])), pa.list_(pa.string())]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        seen = _filter(windows.keys)
        for batch in batches:
            for piece in slices(batch, "text"):
                n_words, spans, items = _hits(piece, windows, seen)
                columns = [pa.array(c, k) for c, k in zip([n_words, spans, [sorted(x) for x in items]], kinds)]
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), *columns], [*kept, "n_words", "spans", "items"])

    return docs.mapInArrow(search, schema)


def _blocks(benchmark: DataFrame, size: int, windows: int) -> Iterator[list[tuple[str, np.ndarray]]]:
    """Items in blocks of at most ``windows`` windows (or one longer item), read one partition at a time."""
    block, n = [], 0
    for row in item_words(benchmark).toLocalIterator():
        words = np.array(row["words"], np.int64).view(np.uint64)
        if block and n + len(words) > windows:
            yield block
            block, n = [], 0
        block.append((row["item_id"] or "", words))
        n += len(words)
    yield block


def _indexed(docs: DataFrame, benchmark: DataFrame, size: int, windows: int) -> Iterator[Windows]:
    """The benchmark's windows, block after block."""
    for block in _blocks(benchmark, size, windows):
        vocabulary = np.unique(np.concatenate([w for _, w in block])) if block else np.zeros(0, np.uint64)
        counts = word_counts(docs, vocabulary) if len(vocabulary) else vocabulary
        yield Windows(block, size, dict(zip(vocabulary.tolist(), counts.tolist())))


def find_items(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, windows: int = WINDOWS) -> DataFrame:
    """doc_id, n_words, spans (places of hit words, disjoint, in order), items (ids found, sorted) of each row."""
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    blocks = _indexed(docs, benchmark, size, windows)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return _searched(docs, first)
    keyed = stored(docs.withColumn("key", F.monotonically_increasing_id()), "keyed")
    return _united(keyed, chain((first, second), blocks)).drop("key")


def _united(keyed: DataFrame, blocks: Iterator[Windows]) -> DataFrame:
    """What ``blocks`` find, together, in each row of ``keyed`` (key, text and maybe doc_id), whose keys differ."""
    together = _searched(keyed, next(blocks))
    for block in blocks:
        together = together.unionByName(_searched(keyed, block))
    united = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))),
        F.expr("cast(array() as array<struct<a: bigint, b: bigint>>)"),
        lambda out, s: F.when(
            s["a"] <= F.try_element_at(out, F.lit(-1))["b"],
            F.concat(
                F.slice(out, 1, F.size(out) - 1),
                F.array(F.struct(F.try_element_at(out, F.lit(-1))["a"].alias("a"), F.greatest(F.try_element_at(out, F.lit(-1))["b"], s["b"]).alias("b"))),
            ),
        ).otherwise(F.concat(out, F.array(s))),
    )
    return together.groupBy(*(c for c in keyed.columns if c != "text"), "n_words").agg(
        united.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )


def judged(found: DataFrame) -> DataFrame:
    """Adds n_hit, n_items and contaminated: at least one word in twenty is hit."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["b"] - s["a"])
    return (
        found.withColumn("n_hit", hit)
        .withColumn("n_items", F.size("items").cast("bigint"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )


def clean(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, windows: int = WINDOWS) -> DataFrame:
    """``docs`` without contaminated rows; a row with the doc_id of one of them stays if it is clean itself."""
    ready(docs.sparkSession)
    blocks = _indexed(docs, benchmark, size, windows)
    first, second = next(blocks), next(blocks, None)
    if second is not None:
        keyed = stored(docs.select(F.monotonically_increasing_id().alias("key"), F.struct("*").alias("whole")), "keyed")
        found = judged(_united(keyed.select("key", "whole.text"), chain((first, second), blocks))).filter("contaminated")
        hit = broadcast_if_small(found.select(F.col("key").alias("hit")))
        return keyed.join(hit, keyed["key"] == hit["hit"], "left_anti").select("whole.*")
    shared = docs.sparkSession.sparkContext.broadcast(first)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        seen = _filter(own.keys)
        for batch in batches:
            for piece in slices(batch, "text"):
                n_words, spans, _ = _hits(piece, own, seen)
                n_hit = np.array([sum(s["b"] - s["a"] for s in row) for row in spans], np.int64)
                yield piece.filter(pa.array((n_hit == 0) | (20 * n_hit < n_words)))

    return docs.mapInArrow(keep, docs.schema)
