"""Quality classifier: a generalised additive model with pairwise interactions.

A text becomes some twenty numbers: shares of kinds of characters, lengths of words and lines, repetition.
Every number is cut into bins. The model adds up one value for each number's bin and one for each cell of a few pairs
of numbers; the sum is the log-odds of label 1. The tables are learnt by cyclic boosting: in turn, each number gets a
shallow tree over its bins, fitted to what the model still misses, at a small rate; then pairs that explain most
of the rest are boosted alike.

Labels are used from at most ``SAMPLE`` rows, those with the smallest hash of their id; rows are scored in full,
with no bound. Null and empty texts have only zeros. Rows whose label is null or neither 0 nor 1, and labels without a
document, teach nothing; with no label at all, every score is 0.5. Repeated rows are scored row by row; a document with
several labels learns from each. A null ``doc_id`` stays. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmark.llm.common import BY_SPACE, mixed, ready, slices, stored, utf8, word_hashes

SAMPLE = 20_000
BINS = 48
GRID = 12
ROUNDS = 150
PAIRS = 6
PAIR_ROUNDS = 40
RATE = 0.08
RIDGE = 4.0
THRESHOLD = 0.3

_KINDS = {
    "lower": range(97, 123),
    "upper": range(65, 91),
    "digit": range(48, 58),
    "space": (9, 11, 12, 13, 32),
    "line": (10,),
    "stop": (46,),
    "comma": (44,),
    "bar": (124,),
    "bang": (33, 63),
    "symbol": tuple(b"#$%&*@^~=+<>\\_"),
    "bracket": tuple(b"()[]{}\"'`/:;-"),
    "high": range(128, 256),
}
_KIND = np.full(256, len(_KINDS), np.uint8)
for _number, _codes in enumerate(_KINDS.values()):
    _KIND[list(_codes)] = _number
_BY_LINE = np.arange(256, dtype=np.uint8)
_BY_LINE[[0, 10]] = (1, 0)
FEATURES = [*_KINDS, "other", "words", "word_length", "short_words", "capital_words", "marked_words", "distinct_words", "lines", "line_words", "distinct_lines"]


def _distinct(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Different hashes in each row."""
    row = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    both = np.sort(row << np.uint64(40) | mixed(hashes) >> np.uint64(24))
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    return np.bincount((both[new] >> np.uint64(40)).astype(np.int64), minlength=len(bounds) - 1)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` for each text."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(rows, dtype=np.int64), size)
    kind = _KIND[data]
    width = len(_KINDS) + 1
    counts = np.bincount(row * width + kind, minlength=rows * width).reshape(rows, width).astype(np.float64)
    blank = (kind == 3) | (kind == 4)
    starts, ends = ~blank, ~blank
    starts[1:] &= blank[:-1]
    ends[:-1] &= blank[1:]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    starts[edge] = ~blank[edge]
    last = offsets[1:][size > 0] - 1
    ends[last] = ~blank[last]
    first, final = np.flatnonzero(starts), np.flatnonzero(ends)
    owner = row[first]
    words = np.maximum(1, np.bincount(owner, minlength=rows))
    per_word = lambda flag: np.bincount(owner[flag], minlength=rows) / words
    marks = np.isin(kind[final], [7, 8, 9])
    hashes, bounds = word_hashes(data, offsets, BY_SPACE)
    line_hashes, line_bounds = word_hashes(data, offsets, _BY_LINE)
    lines = np.diff(line_bounds)
    return np.column_stack(
        [
            counts / np.maximum(1, size)[:, None],
            np.log1p(np.diff(bounds)),
            (size - counts[:, 3] - counts[:, 4]) / words,
            per_word(final - first < 2),
            per_word(kind[first] == 1),
            per_word(marks),
            _distinct(hashes, bounds) / words,
            np.log1p(lines),
            np.log1p(np.diff(bounds) / np.maximum(1, lines)),
            _distinct(line_hashes, line_bounds) / np.maximum(1, lines),
        ]
    )


def _leaves(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Values of a shallow tree over ordered bins with gradients and weights."""
    def value(a: int, b: int) -> float:
        return g[a:b].sum() / (h[a:b].sum() + RIDGE)

    out = np.empty(len(g))
    parts = [(0, len(g))]
    for _ in range(depth):
        split = []
        for a, b in parts:
            if b - a < 2:
                split.append((a, b))
                continue
            gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            gr, hr = g[a:b].sum() - gl, h[a:b].sum() - hl
            cut = a + 1 + int(np.argmax(gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE)))
            split += [(a, cut), (cut, b)]
        parts = split
    for a, b in parts:
        out[a:b] = value(a, b)
    return out


def _cells(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree over a grid: one cut across, one cut of its own on either side. Its values, and what it gains."""
    best, out = -1.0, np.zeros_like(g)
    for cut in range(1, len(g)):
        sides, gain = [], 0.0
        for part in (slice(0, cut), slice(cut, None)):
            a, b = g[part].sum(0), h[part].sum(0)
            left, weight = np.cumsum(a)[:-1], np.cumsum(b)[:-1]
            score = left**2 / (weight + RIDGE) + (a.sum() - left) ** 2 / (b.sum() - weight + RIDGE)
            k = int(np.argmax(score))
            gain += score[k]
            sides.append((part, k + 1, left[k] / (weight[k] + RIDGE), (a.sum() - left[k]) / (b.sum() - weight[k] + RIDGE)))
        if gain > best:
            best = gain
            for part, k, low, high in sides:
                out[part, :k], out[part, k:] = low, high
    return out, best


class AdditiveModel:
    """Look-up tables: ``tables[f][bin]`` for each feature and ``grids[(f, g)][bin, bin]`` for some pairs."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        places = np.linspace(0, 1, BINS + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(c, places)) if len(c) else np.zeros(0) for c in x.T]
        self.coarse = [np.unique(np.quantile(c, np.linspace(0, 1, GRID + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.grids: dict[tuple[int, int], np.ndarray] = {}
        self.base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        if len(y):
            self._boost(x, y)

    def _boost(self, x: np.ndarray, y: np.ndarray) -> None:
        fine = [np.searchsorted(c, v, side="right") for c, v in zip(self.cuts, x.T)]
        rough = [np.searchsorted(c, v, side="right") for c, v in zip(self.coarse, x.T)]
        total = np.full(len(y), self.base)

        def missed() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-total))
            return y - p, p * (1 - p)

        for _ in range(ROUNDS):
            for f, table in enumerate(self.tables):
                g, h = missed()
                step = RATE * _leaves(np.bincount(fine[f], g, len(table)), np.bincount(fine[f], h, len(table)), 2)
                table += step
                total += step[fine[f]]

        def grid(i: int, j: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
            shape = (len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)
            cell = rough[i] * shape[1] + rough[j]
            size = shape[0] * shape[1]
            return _cells(np.bincount(cell, g, size).reshape(shape), np.bincount(cell, h, size).reshape(shape))

        g, h = missed()
        useful = [i for i, c in enumerate(self.coarse) if len(c)]
        pairs = [(i, j) for n, i in enumerate(useful) for j in useful[n + 1 :]]
        chosen = sorted(pairs, key=lambda p: -grid(*p, g, h)[1])[:PAIRS]
        self.grids = {(i, j): np.zeros((len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)) for i, j in chosen}
        for _ in range(PAIR_ROUNDS):
            for i, j in chosen:
                step = RATE * grid(i, j, *missed())[0]
                self.grids[i, j] += step
                total += step[rough[i], rough[j]]

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[f], x[:, f], side="right")]
        for (i, j), grid in self.grids.items():
            total += grid[np.searchsorted(self.coarse[i], x[:, i], side="right"), np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-total))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> AdditiveModel:
    """Fit on the documents of at most ``sample`` rows of ``labels`` (doc_id, label), and on about as many documents."""
    ready(docs.sparkSession)
    chosen = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("double").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                x = features(*utf8(piece.column("text")))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``sample`` labels
    measured = stored(rows.select("doc_id", "y", "text").mapInArrow(measure, "doc_id bigint, y double, x array<double>"), "measured")
    if (many := measured.count()) > sample:  # labelled ids that repeat: about ``sample`` of their rows, by hash
        measured = measured.filter(F.pmod(F.xxhash64("doc_id", "y", F.monotonically_increasing_id()), F.lit(many)) < sample)
    found = measured.toPandas()
    x = np.stack(found["x"]) if len(found) else np.zeros((0, len(FEATURES)))
    order = np.lexsort((*x.T[::-1], found["y"], found["doc_id"]))  # the same order whatever the tasks
    x, found = x[order], found.iloc[order]
    return AdditiveModel(x, found["y"].to_numpy(np.float64))


def score(docs: DataFrame, model: AdditiveModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the probability of label 1 (``score``) of every text."""
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "_text"):
                value = shared.value.scores(features(*utf8(piece.column("_text"))))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in keep), pa.array(value)], [*keep, "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(judge, f"{kinds}, score double")


def accepted(column: str = "score", threshold: float = THRESHOLD) -> Column:
    return F.col(column) >= threshold


def keep_accepted(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``."""
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                yield piece.filter(pa.array(shared.value.scores(features(*utf8(piece.column("text")))) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
