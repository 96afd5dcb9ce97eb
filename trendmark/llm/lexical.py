"""Ranked lexical search by dense blocks.

Queries come in blocks of at most ``BLOCK`` terms, whatever their number; a block is what is sent to the tasks. For each
block the documents are read twice. The first reading adds up, over all documents, how many have terms, how many terms
there are and how many documents hold each term of the block. The second multiplies tiles: ``ITEMS`` queries with their own
small vocabulary, weights times repeats, by the impacts of these terms in ``DOCS`` documents, in float64 by BLAS. All numbers are
integers, and a vocabulary is cut where a query's partial sum could reach 2**53, so the products are exact; partial
sums are added as 64-bit integers. After every tile a task keeps each query's best ``k`` documents so far, with
all that would tie decided by id; the tasks' lists are merged by windows in two steps.

Terms are runs of digits, letters and all non-ASCII, A-Z lower-cased, compared by 64-bit hashes. Null or termless documents
count for nothing and are never found; null or termless queries find nothing. Each row is a document, or a query, of its
own, also where ids repeat: rows of one query id are ranked apart. Null document ids come last among equal scores. An empty table
gives no row. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendmark.llm.common import BY_SYMBOL, ready, slices, utf8, word_hashes

K = 20
BLOCK = 1 << 17
ITEMS = 64
DOCS = 512
#: No impact reaches this.
IMPACT = 10**6
#: Products of float64 stay exact below 2**53.
EXACT = 2**53 // IMPACT

_LAST = np.iinfo(np.int64).max
_BEST = "item bigint, item_id string, doc_id bigint, score bigint, part int"


def item_terms(items: DataFrame) -> DataFrame:
    """item_id as text, and the hashes of the item's terms, for items that have terms."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                terms, bounds = word_hashes(*utf8(piece.column("text")), BY_SYMBOL)
                rows = [terms[a:b].view(np.int64) for a, b in zip(bounds[:-1], bounds[1:]) if a < b]
                kept = piece.column("item_id").filter(pa.array(np.diff(bounds) > 0))
                yield pa.RecordBatch.from_arrays([kept, pa.array(rows, pa.list_(pa.int64()))], ["item_id", "terms"])

    return items.select(F.col("item_id").cast("string"), "text").mapInArrow(hashed, "item_id string, terms array<bigint>")


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple[str | None, np.ndarray]]]:
    """Items in blocks of at most ``most`` terms, or one item with more; read one partition at a time."""
    block, held = [], 0
    for row in item_terms(items).toLocalIterator():
        terms = np.array(row["terms"], np.int64).view(np.uint64)
        if block and held + len(terms) > most:
            yield block
            block, held = [], 0
        block.append((row["item_id"], terms))
        held += len(terms)
    if block:
        yield block


class Found:
    """Occurrences of a block's terms in some documents."""

    def __init__(self, piece: pa.RecordBatch, keys: np.ndarray, low: np.ndarray):
        terms, bounds = word_hashes(*utf8(piece.column("text")), BY_SYMBOL)
        self.size = np.diff(bounds)
        places = np.flatnonzero(low[(terms & np.uint64(len(low) - 1)).astype(np.int64)])  # a cheap first look
        which = np.minimum(np.searchsorted(keys, terms[places]), max(len(keys) - 1, 0))
        same = keys[which] == terms[places]
        row = np.searchsorted(bounds, places[same], side="right") - 1
        both, self.tf = np.unique(row * len(keys) + which[same], return_counts=True)
        self.row, self.key = both // len(keys), both % len(keys)


class Block:
    """Some queries: their terms, and per tile of queries the vocabulary and the weights."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]]):
        self.items = items
        self.keys = np.unique(np.concatenate([terms for _, terms in items]))
        self.low = np.zeros(1 << 16, bool)
        self.low[(self.keys & np.uint64(len(self.low) - 1)).astype(np.int64)] = True

    def weigh(self, documents: int, occurrences: int, holding: np.ndarray) -> None:
        """Make the tiles, once it is known in how many documents each term occurs."""
        self.documents, self.occurrences = documents, occurrences
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in holding.tolist()], np.int64)
        self.tiles = []
        for first in range(0, len(self.items), ITEMS):
            group = [np.unique(np.searchsorted(self.keys, terms), return_counts=True) for _, terms in self.items[first : first + ITEMS]]
            own = np.unique(np.concatenate([key for key, _ in group]))
            matrix = np.zeros((len(group), len(own)), np.int64)
            for row, (key, repeats) in enumerate(group):
                matrix[row, np.searchsorted(own, key)] = weight[key] * repeats
            self.tiles.append((first, own, exact_parts(matrix)))

    def scores(self, found: Found, a: int, b: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each tile of queries: its first, and the scores of documents a to b of ``found`` as queries by documents."""
        share, rest = divmod(25 * self.documents, max(1, self.occurrences))
        size = found.size if int(found.size.max(initial=0)) * rest < 2**63 else found.size.astype(object)
        m = (75 + size * share + size * rest // max(1, self.occurrences)).astype(np.int64)
        part = slice(*np.searchsorted(found.row, (a, b)))
        row, key, tf = found.row[part], found.key[part], found.tf[part]
        impact = 10**9 * tf // (1000 * tf + 12 * m[row])
        for first, own, parts in self.tiles:
            column = np.minimum(np.searchsorted(own, key), len(own) - 1)
            here = own[column] == key
            impacts = np.zeros((len(own), b - a))
            impacts[column[here], row[here] - a] = impact[here]
            yield first, sum((weights @ impacts[columns]).astype(np.int64) for columns, weights in parts)


def exact_parts(matrix: np.ndarray, exact: int = EXACT) -> list[tuple[np.ndarray, np.ndarray]]:
    """Columns of ``matrix`` in groups, and the groups' weights as float64, so that no row of a group adds up to ``exact``."""
    columns, weights = [], []
    for column in range(matrix.shape[1]):
        left = matrix[:, column]
        while True:
            columns.append(column)
            weights.append(np.minimum(left, exact - 1))
            left = left - weights[-1]
            if not left.any():
                break
    parts, begin, held = [], 0, np.zeros(len(matrix), np.int64)
    for i, own in enumerate(weights):
        if ((held + own) >= exact).any():
            parts.append((begin, i))
            begin, held = i, np.zeros(len(matrix), np.int64)
        held = held + own
    parts.append((begin, len(weights)))
    return [(np.array(columns[a:b]), np.column_stack(weights[a:b]).astype(np.float64)) for a, b in parts]


class Best:
    """The best ``k`` documents of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.item, self.score, self.doc_id, self.none = (np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, bool))
        self.least, self.worst = np.zeros(queries, np.int64), np.full(queries, -1, np.int64)

    def add(self, first: int, scores: np.ndarray, doc_ids: np.ndarray, none: np.ndarray) -> None:
        least, worst = (x[first : first + len(scores), None] for x in (self.least, self.worst))
        row, column = np.nonzero((scores > least) | ((scores == least) & (doc_ids <= worst) & (scores > 0)))
        if not len(row):
            return
        item = np.concatenate((self.item, first + row))
        score = np.concatenate((self.score, scores[row, column]))
        doc_id, none = np.concatenate((self.doc_id, doc_ids[column])), np.concatenate((self.none, none[column]))
        order = np.lexsort((doc_id, none, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        order = order[place < self.k]
        self.item, self.score, self.doc_id, self.none = item[order], score[order], doc_id[order], none[order]
        last = np.flatnonzero(place[place < self.k] == self.k - 1)
        self.least[self.item[last]], self.worst[self.item[last]] = self.score[last], self.doc_id[last]


def _statistics(docs: DataFrame, block: Block) -> tuple[int, int, np.ndarray]:
    """Documents with terms, terms in all, and documents that hold each term of the block."""
    shared = docs.sparkSession.sparkContext.broadcast((block.keys, block.low))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, low = shared.value
        holding, documents, occurrences = np.zeros(len(keys), np.int64), 0, 0
        for batch in batches:
            for piece in slices(batch, "text"):
                found = Found(piece, keys, low)
                holding += np.bincount(found.key, minlength=len(keys))
                documents += int((found.size > 0).sum())
                occurrences += int(found.size.sum())
        held = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, [-1, -2])), pa.array(np.append(holding[held], [documents, occurrences]))], ["key", "n"])

    rows = docs.select("text").mapInArrow(counted, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    sums = {row["key"]: row["n"] for row in rows.collect()}  # a row for each term of the block
    return sums.get(-1, 0), sums.get(-2, 0), np.array([sums.get(i, 0) for i in range(len(block.keys))], np.int64)


def _searched(docs: DataFrame, block: Block, number: int, k: int) -> DataFrame:
    """The best of each task for each query of the block."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        best = Best(len(own.items), k)
        for batch in batches:
            for piece in slices(batch, "text"):
                found = Found(piece, own.keys, own.low)
                none = piece.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                doc_ids = piece.column("doc_id").fill_null(_LAST).to_numpy(zero_copy_only=False)
                for a in range(0, piece.num_rows, DOCS):
                    b = min(a + DOCS, piece.num_rows)
                    for first, scores in own.scores(found, a, b):
                        best.add(first, scores, doc_ids[a:b], none[a:b])
        names = pa.array([item for item, _ in own.items], pa.string()).take(pa.array(best.item))
        part = np.full(len(best.item), TaskContext.get().partitionId() % 64, np.int32)
        ids = pa.array(best.doc_id, mask=best.none)
        yield pa.RecordBatch.from_arrays([pa.array(best.item + number), names, ids, pa.array(best.score), pa.array(part)], ["item", "item_id", "doc_id", "score", "part"])

    return docs.mapInArrow(search, _BEST)


def search(docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item with a score above 0."""
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    number, parts = 0, []
    for own in _blocks(items, block):
        queries = Block(own)
        queries.weigh(*_statistics(docs, queries))
        parts.append(_searched(docs, queries, number, k))
        number += len(own)
    found = reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], _BEST)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).filter(F.col("rank") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.select(F.col("item_id").cast(items.schema["item_id"].dataType), F.col("rank").cast("int"), "doc_id", "score")
