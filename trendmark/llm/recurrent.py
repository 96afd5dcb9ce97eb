"""Gated recurrent language model: log-probabilities of whole documents.

Tokens are white-space words of the lower-cased text (A-Z only) and an end. The ``CLASSES * WIDTH`` most frequent are
words of the model, in classes of ``WIDTH`` by frequency; all other words fall into tail classes by their form. The
output is factored: a softmax over classes, then, inside a frequent class, a softmax over its words, or inside a
tail class the word's share of that class over the whole training text, add-one smoothed with one more for
the words never seen. So every text has a probability, and those of all texts sum to one at most.

A gated recurrent unit reads the tokens. It learns by truncated backpropagation in numpy: every task trains a copy
on its documents, and copies are averaged, weighted by tokens, once a round. Every training document is read whole, from
its first word to its end, in one of the ``ROUNDS`` rounds, chosen by a hash of its text; all counts come from all training
text. Training and scoring carry the state from window to window through the whole document, however long.

Words are compared by 64-bit hashes. Counts of the ``KNOWN`` most frequent words are broadcast, those of the model's words always; all others are joined. Null and
empty texts have the end token alone. With no training document, probabilities are those of the untrained unit and
no token is known. A text's score depends on the model and the text, not on the texts scored with it. Rows are scored one by one,
also repeated ones and those with null ``doc_id``. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendmark.llm.common import BY_SPACE, ready, slices, span_hashes, spans, stored, utf8
from trendmark.llm.piece_table import Numbers

CLASSES, WIDTH, TAILS = 40, 32, 24
WORDS = CLASSES * WIDTH
HIDDEN = 24
KNOWN = 1 << 18
LANES, WINDOW = 256, 64
TRAIN_LANES, TRAIN_WINDOW = 64, 32
ROUNDS, RATE = 2, 0.01
#: Tokens that a task scores, or learns from, together.
TOGETHER = 1 << 21
_HELD = 1 << 19
#: Words of one class that are looked at together.
BLOCK = 32
_MERGE = 64
#: The end token's key; words have hashes.
END = 0


class Words:
    """The words of some texts: keys (hashes of the lower-cased words, or ``END`` after each text) and tail classes by form."""

    def __init__(self, column: pa.Array):
        data, offsets = utf8(column)
        code = BY_SPACE[data]
        begin, end = spans(code != 0, offsets)
        first = np.searchsorted(begin, offsets)
        keys = np.maximum(span_hashes(code, begin, end), np.uint64(1)) if len(begin) else np.zeros(0, np.uint64)
        self.keys = np.insert(keys, first[1:], np.uint64(END))
        # A class by the word's form: ASCII or not, how it ends, and its length.
        last, size = data[end - 1] | 32 * ((data[end - 1] >= 65) & (data[end - 1] <= 90)), end - begin
        ending = np.select([last == ord("."), last == ord(","), last < 97], [1, 2, 3], 0)
        longer = np.concatenate(([0], np.cumsum(data >= 128)))
        form = 12 * (longer[end] == longer[begin]) + 3 * ending + (size >= 6) + (size >= 10)
        self.form = np.insert(form.astype(np.int32), first[1:], _END_FORM)
        self.bounds = first + np.arange(len(first))


#: The end's tail class, where it is no word of the model: ASCII, no letter, short.
_END_FORM = 12 + 3 * 3


def count_words(docs: DataFrame) -> DataFrame:
    """word (key), k (tail class), n over all ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0

        def merged() -> tuple[np.ndarray, ...]:
            word, k, n = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(word, kind="stable")
            first = np.flatnonzero(np.diff(word[order], prepend=~word[order[:1]]))
            return word[order][first], k[order][first], np.add.reduceat(n[order], first)

        def rows(part: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), pa.array(part[1]), pa.array(part[2])], ["word", "k", "n"])

        for batch in batches:
            for piece in slices(batch, "text"):
                found = Words(piece.column("text"))
                word, first, n = np.unique(found.keys, return_index=True, return_counts=True)
                parts.append((word, found.form[first], n))
                held += len(word)
                if held > 2 * _HELD:
                    parts = [merged()]
                    held = len(parts[0][0])
                    if held > _HELD:
                        yield rows(parts[0])
                        parts, held = [], 0
        if parts:
            yield rows(merged())

    counted = docs.select("text").mapInArrow(count, "word bigint, k int, n bigint")
    return counted.groupBy("word").agg(F.max("k").alias("k"), F.sum("n").alias("n"))


class Vocabulary:
    """The most frequent words with their counts, and what the tail classes hold."""

    def __init__(self, keys: np.ndarray, form: np.ndarray, count: np.ndarray, tail: dict[int, tuple[int, int]], tokens: int, distinct: int):
        self.keys, self.count = keys, count.astype(np.float64)
        self.numbers = Numbers(max(1, len(keys)))
        self.numbers.add(_spread(keys))
        self.tokens, self.distinct = tokens, distinct
        # Input of each known word: itself, or its tail class.
        self.input = np.where(np.arange(len(keys)) < WORDS, np.arange(len(keys)), WORDS + form).astype(np.int32)
        self.tail_n, self.tail_v = np.zeros(TAILS), np.zeros(TAILS)
        for k, (n, v) in tail.items():
            self.tail_n[k], self.tail_v[k] = n, v

    def known(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word (-1 if it is not known), and its input."""
        number = self.numbers.find(_spread(found.keys))
        return number, np.where(number >= 0, np.append(self.input, 0)[number], WORDS + found.form).astype(np.int32)

    def log_tail(self) -> np.ndarray:
        return np.log10(self.tail_n + self.tail_v + 1)


def _spread(keys: np.ndarray) -> np.ndarray:
    """Keys for a table of numbers, which has none for 0."""
    return np.where(keys == END, np.uint64(0x9E3779B97F4A7C15), keys)


def learn_vocabulary(counts: DataFrame) -> Vocabulary:
    # The least count of which all words are known: a row for each different count is looked at, not each word.
    at_least = F.sum("words").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0))
    by_count = counts.groupBy("n").agg(F.count("*").alias("words")).withColumn("at_least", at_least)
    least = by_count.filter(F.col("at_least") <= KNOWN).agg(F.min("n")).first()[0]
    order = [F.desc("n"), F.asc("word")]
    found = counts.orderBy(*order).limit(WORDS)  # the model's words, however many others are as frequent
    if least is not None:
        found = found.union(counts.filter(F.col("n") >= least)).distinct()
    top = found.orderBy(*order).toArrow()
    keys, form, count = (top[c].to_numpy() for c in ("word", "k", "n"))
    totals = counts.agg(F.sum("n"), F.count("*")).first()
    tail = counts.filter(~F.col("word").isin(keys[:WORDS].tolist())).groupBy("k").agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    held = {row["k"]: (row["n"], row["v"]) for row in tail.collect()}
    return Vocabulary(keys.view(np.uint64), form, count, held, totals[0] or 0, totals[1])


class Unit:
    """The recurrent unit and its factored output."""

    SHAPES = {
        "x": (WORDS + TAILS, 3 * HIDDEN),  # each input's part in both gates and the new state
        "u": (HIDDEN, 3 * HIDDEN),
        "wc": (HIDDEN, CLASSES + TAILS),
        "bc": (CLASSES + TAILS,),
        "ww": (CLASSES, HIDDEN, WIDTH),
        "bw": (CLASSES, WIDTH),
    }

    def __init__(self, flat: np.ndarray):
        self.flat, start = flat, 0
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, flat[start : start + size].reshape(shape))
            start += size

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(s)) for s in cls.SHAPES.values())

    @classmethod
    def fresh(cls, vocabulary: Vocabulary) -> Unit:
        """Small random weights; output biases give every class and word its share of the training text."""
        unit = cls(np.random.default_rng(3).normal(0, 0.08, cls.size()).astype(np.float32))
        n = np.zeros(WORDS)
        own = vocabulary.count[:WORDS]
        n[: len(own)] = own
        by_class = np.concatenate((n.reshape(CLASSES, WIDTH).sum(1), vocabulary.tail_n + 1))
        unit.bc[:] = np.where(by_class > 0, np.log(np.maximum(by_class, 1e-9) / by_class.sum()), -30)
        unit.bw[:] = np.where(n > 0, np.log(np.maximum(n, 1e-9)), -30).reshape(CLASSES, WIDTH)
        unit.bw -= np.log(np.exp(unit.bw).sum(1, keepdims=True))
        unit.x[:, :HIDDEN] += 1  # gates start open for the old state
        return unit

    def read(self, h: np.ndarray, inputs: np.ndarray, ends: np.ndarray, trace: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States before each token of a window (time, lane), and the state after it."""
        steps, width = inputs.shape
        # Lanes come last here: parts of gates and states are then contiguous.
        kept = steps if trace is not None else 1
        states, new = np.empty((steps, HIDDEN, width), np.float32), np.empty((kept, HIDDEN, width), np.float32)
        gates, inner = np.empty((kept, 2 * HIDDEN, width), np.float32), np.empty((kept, 3 * HIDDEN, width), np.float32)
        given = np.ascontiguousarray(self.x[inputs].transpose(0, 2, 1))
        given[:, : 2 * HIDDEN] *= 0.5  # a gate is half a hyperbolic tangent of half its input, and a half
        u = self.u.T.copy()
        u[: 2 * HIDDEN] *= 0.5
        for_gates, for_new, ending = given[:, : 2 * HIDDEN], given[:, 2 * HIDDEN :], ends.any(1).tolist()
        h = np.array(h.T, order="C")
        for t in range(steps):
            state, a, g, n = states[t], inner[t % kept], gates[t % kept], new[t % kept]
            state[:] = h
            np.matmul(u, state, out=a)
            np.add(for_gates[t], a[: 2 * HIDDEN], out=g)
            np.tanh(g, out=g)
            g *= 0.5
            g += 0.5
            np.multiply(g[HIDDEN:], a[2 * HIDDEN :], out=n)
            n += for_new[t]
            np.tanh(n, out=n)
            np.subtract(state, n, out=h)
            h *= g[:HIDDEN]
            h += n
            if ending[t]:
                h[:, ends[t]] = 0
        if trace is not None:
            trace.extend((states, gates[:, :HIDDEN], gates[:, HIDDEN:], new, inner[:, 2 * HIDDEN :]))
        return np.ascontiguousarray(states.transpose(0, 2, 1)), np.ascontiguousarray(h.T)

    def _classes(self, states: np.ndarray) -> np.ndarray:
        """Log-probability of each class (class, state)."""
        logits = self.wc.T @ states.T
        logits += self.bc[:, None]
        logits -= logits.max(0)
        logits -= np.log(np.exp(logits).sum(0))
        return logits

    def _blocks(self, inputs: np.ndarray) -> tuple[np.ndarray, ...]:
        """The frequent words' places by class, each one's slot in blocks of ``BLOCK`` of one class, and the blocks' classes."""
        places = np.flatnonzero(inputs < WORDS)
        cls = inputs[places] // WIDTH
        order = np.argsort(cls, kind="stable")
        count = np.bincount(cls, minlength=CLASSES)
        blocks = -(-count // BLOCK)
        shift = (np.cumsum(blocks) - blocks) * BLOCK - (np.cumsum(count) - count)
        return places[order], np.arange(len(order)) + shift[cls[order]], np.repeat(np.arange(CLASSES), blocks)

    def _words(self, states: np.ndarray, places: np.ndarray, slot: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States in blocks (block, slot), and the logits of their class's words less the largest (block, word, slot)."""
        dealt = np.zeros((len(cls) * BLOCK, HIDDEN), np.float32)
        dealt[slot] = states[places]
        dealt = dealt.reshape(len(cls), BLOCK, HIDDEN)
        logits = self.ww.transpose(0, 2, 1)[cls] @ dealt.transpose(0, 2, 1)
        logits += self.bw[cls][:, :, None]
        logits -= logits.max(1, keepdims=True)
        return dealt, logits

    def log_probabilities(self, states: np.ndarray, inputs: np.ndarray) -> np.ndarray:
        """Of each input after its state: the class, and the word inside a frequent class."""
        cls = np.where(inputs < WORDS, inputs // WIDTH, inputs - WORDS + CLASSES)
        out = np.empty(len(inputs))
        for a in range(0, len(inputs), 2048):  # what stays in a core's cache
            some = cls[a : a + 2048]
            out[a : a + 2048] = self._classes(states[a : a + 2048])[some, np.arange(len(some))]
        places, slot, by_block = self._blocks(inputs)
        _, logits = self._words(states, places, slot, by_block)
        block, at = np.divmod(slot, BLOCK)
        out[places] += logits[block, inputs[places] % WIDTH, at] - np.log(np.exp(logits).sum(1))[block, at]
        return out

    def gradient(self, h: np.ndarray, inputs: np.ndarray, ends: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the mean loss over a window's real tokens, with no error from later windows; and the last state."""
        g = Unit(np.zeros_like(self.flat))
        trace: list = []
        before, last = self.read(h, inputs, ends, trace)
        flat, at, weight = before.reshape(-1, HIDDEN), inputs.ravel(), real.ravel().astype(np.float32) / max(1, real.sum())
        cls = np.where(at < WORDS, at // WIDTH, at - WORDS + CLASSES)
        miss = self.wc.T @ flat.T
        miss += self.bc[:, None]
        miss -= miss.max(0)
        np.exp(miss, out=miss)
        miss *= weight / miss.sum(0)
        miss[cls, np.arange(len(at))] -= weight
        g.wc[:], g.bc[:] = (miss @ flat).T, miss.sum(1)
        back = np.ascontiguousarray((self.wc @ miss).T)
        places, slot, by_block = self._blocks(at)
        if len(places):
            dealt, p = self._words(flat, places, slot, by_block)
            np.exp(p, out=p)
            share = np.zeros(len(by_block) * BLOCK, np.float32)  # none for empty slots
            share[slot] = weight[places]
            p *= share.reshape(-1, 1, BLOCK) / p.sum(1, keepdims=True)
            block, within = np.divmod(slot, BLOCK)
            p[block, at[places] % WIDTH, within] -= weight[places]
            first = np.flatnonzero(np.diff(by_block, prepend=-1))
            ww, bw = dealt.transpose(0, 2, 1) @ p.transpose(0, 2, 1), p.sum(2)
            for c, a, b in zip(by_block[first].tolist(), first.tolist(), [*first[1:].tolist(), len(by_block)]):
                g.ww[c], g.bw[c] = (ww[a], bw[a]) if b == a + 1 else (ww[a:b].sum(0), bw[a:b].sum(0))
            back[places] += (p.transpose(0, 2, 1) @ self.ww.transpose(0, 2, 1)[by_block]).reshape(-1, HIDDEN)[slot]
        back = np.ascontiguousarray(back.reshape(before.shape).transpose(0, 2, 1))
        states, z, r, new, inner = trace
        # What an error of the state is multiplied by on its way into the gates and the new state.
        shut = 1 - z
        by_z, by_n, by_r = states - new, 1 - new * new, 1 - r
        by_z *= z
        by_z *= shut
        by_n *= shut
        by_r *= inner
        by_r *= r
        steps, width = inputs.shape
        through, fresh = np.empty((steps, 3 * HIDDEN, width), np.float32), np.empty(states.shape, np.float32)
        ending, error, more = ends.any(1).tolist(), np.zeros((HIDDEN, width), np.float32), np.empty((HIDDEN, width), np.float32)
        for t in range(steps - 1, -1, -1):
            if ending[t]:
                error[:, ends[t]] = 0
            own, dn = through[t], fresh[t]
            np.multiply(error, by_z[t], out=own[:HIDDEN])
            np.multiply(error, by_n[t], out=dn)
            np.multiply(dn, by_r[t], out=own[HIDDEN : 2 * HIDDEN])
            np.multiply(dn, r[t], out=own[2 * HIDDEN :])
            error *= z[t]
            np.matmul(self.u, own, out=more)
            error += more
            error += back[t]
        given = through.transpose(0, 2, 1).reshape(-1, 3 * HIDDEN)
        g.u[:] = flat.T @ given
        given[:, 2 * HIDDEN :] = fresh.transpose(0, 2, 1).reshape(-1, HIDDEN)
        order = np.argsort(at, kind="stable")
        heads = np.flatnonzero(np.diff(at[order], prepend=-1))
        n = np.diff(heads, append=len(order))
        once, often = order[heads[n == 1]], np.flatnonzero(n > 1)
        g.x[at[once]] = given[once]
        if len(often):
            many = order[np.repeat(n > 1, n)]
            g.x[at[order[heads[often]]]] = np.add.reduceat(given[many], np.cumsum(n[often]) - n[often])
        return g.flat, last


def lanes(lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Lay sequences end to end in ``n`` lanes of about equal length: each one's lane and start, and the longest lane.

    Lanes are numbered from the longest.
    """
    heap = [(0, i) for i in range(n)]
    lane, start = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        used, k = heap[0]
        lane[i], start[i] = k, used
        heapq.heapreplace(heap, (used + int(lengths[i]), k))
    load = np.zeros(n, np.int64)
    for used, k in heap:
        load[k] = used
    rank = np.empty(n, np.int64)
    rank[np.argsort(-load, kind="stable")] = np.arange(n)
    return rank[lane], start, int(load.max(initial=0))


def laid_out(sequences: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (time, lane; -1 where a lane has ended), where sequences end, each one's lane and start, and the lengths."""
    length = np.array([len(s) for s in sequences], np.int64)
    lane, start, steps = lanes(length, n)
    grid = np.full((n, steps), -1, np.int32)
    for s, k, a in zip(sequences, lane.tolist(), start.tolist()):
        grid[k, a : a + len(s)] = s
    ends = np.zeros((steps, n), bool)
    ends[start + length - 1, lane] = True
    return np.ascontiguousarray(grid.T), ends, lane, start, length


def sequence_scores(unit: Unit, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log-probability of each sequence of inputs; the state goes on from window to window, and ends with it."""
    grid, ends, lane, start, length = laid_out(sequences, min(LANES, max(1, len(sequences))))
    sums = np.zeros((len(grid) + 1, grid.shape[1]))
    h = np.zeros((grid.shape[1], HIDDEN), np.float32)
    for a in range(0, len(grid), WINDOW):
        width = int((grid[a] >= 0).sum())  # lanes that have ended are the last ones
        window = grid[a : a + WINDOW, :width]
        inputs = np.maximum(window, 0)
        states, h = unit.read(h[:width], inputs, ends[a : a + WINDOW, :width])
        real = window.ravel() >= 0
        value = np.zeros(window.size)
        value[real] = unit.log_probabilities(states.reshape(-1, HIDDEN)[real], inputs.ravel()[real])
        sums[a + 1 : a + 1 + len(window), :width] = value.reshape(window.shape)
    np.cumsum(sums, axis=0, out=sums)
    return sums[start + length, lane] - sums[start, lane]


def train(unit: Unit, sequences: list[np.ndarray], state: tuple) -> None:
    """Improve ``unit`` in place by one pass of truncated backpropagation; ``state`` is Adam's."""
    grid, ends, *_ = laid_out(sequences, min(TRAIN_LANES, max(1, len(sequences))))
    h = np.zeros((grid.shape[1], HIDDEN), np.float32)
    mean, square, steps = state
    for a in range(0, len(grid), TRAIN_WINDOW):
        width = int((grid[a] >= 0).sum())
        window = grid[a : a + TRAIN_WINDOW, :width]
        g, h = unit.gradient(h[:width], np.maximum(window, 0), ends[a : a + TRAIN_WINDOW, :width], window >= 0)
        norm = float(np.linalg.norm(g))
        if norm > 1:
            g *= 1 / norm
        steps[0] += 1
        # Sums of gradients and of their squares, 10 and 100 times the means that Adam keeps.
        mean *= 0.9
        mean += g
        g *= g
        square *= 0.99
        square += g
        size = RATE * np.sqrt(1 - 0.99 ** steps[0]) / (1 - 0.9 ** steps[0])
        np.sqrt(square, out=g)
        g += 1e-5
        np.divide(mean, g, out=g)
        g *= size
        unit.flat -= g


def learn_unit(docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Unit:
    """Train on the whole text of all ``docs``, each in one round."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(vocabulary)
    unit = Unit.fresh(vocabulary)

    def averaged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n = rows["n"].to_numpy(np.float64)
        flat = sum(w * np.frombuffer(f, np.float32).astype(np.float64) for w, f in zip(n, rows["flat"])) / n.sum()
        return pd.DataFrame({"place": [int(key[0])], "n": [int(n.sum())], "flat": [flat.astype(np.float32).tobytes()]})

    for turn in range(rounds):
        weights = context.broadcast(unit.flat)

        def learn(batches: Iterator[pa.RecordBatch], turn: int = turn, weights=weights) -> Iterator[pa.RecordBatch]:
            own = Unit(weights.value.copy())
            state = (np.zeros_like(own.flat), np.zeros_like(own.flat), [0])
            held, tokens, n = [], 0, 0
            for batch in batches:
                for piece in slices(batch, "text"):
                    texts = piece.column("text").cast(pa.binary()).to_pylist()
                    chosen = pa.array([zlib.crc32(text or b"") % rounds == turn for text in texts])
                    found = Words(piece.column("text").filter(chosen))
                    _, inputs = shared.value.known(found)
                    held += np.split(inputs, found.bounds[1:-1]) if len(found.bounds) > 1 else []
                    tokens += len(inputs)
                    if tokens > TOGETHER:
                        train(own, held, state)
                        held, tokens, n = [], 0, n + tokens
            if held:
                train(own, held, state)
                n += tokens
            if n:
                place = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays([pa.array([place], pa.int64()), pa.array([n], pa.int64()), pa.array([own.flat.tobytes()], pa.binary())], ["place", "n", "flat"])

        copies = stored(docs.select("text").mapInArrow(learn, "place bigint, n bigint, flat binary"), "copies")
        many = copies.count()
        while many > 1:
            copies = copies.groupBy(F.floor(F.col("place") / _MERGE).alias("place")).applyInPandas(averaged, "place bigint, n bigint, flat binary")
            copies = stored(copies, "copies")
            many = copies.count()
        if many:
            unit = Unit(np.frombuffer(copies.first()["flat"], np.float32).copy())
    return unit


_SCORED = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, rare array<bigint>"


def score_documents(docs: DataFrame, learns: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; rows with ``learns`` teach."""
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint"), "text", (~learns).alias("held_out"))
    training = docs.filter(~F.col("held_out"))
    counts = stored(count_words(training), "counts")
    vocabulary = learn_vocabulary(counts)
    unit = learn_unit(training, vocabulary)
    context = docs.sparkSession.sparkContext
    shared, weights = context.broadcast(vocabulary), context.broadcast(unit.flat)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        own_unit = Unit(weights.value)
        log_count = np.append(np.log10(known.count + 1), 0)
        log_tail = known.log_tail()
        row = TaskContext.get().partitionId() << 33
        held: list[list] = [[] for _ in range(7)]
        sequences: list[np.ndarray] = []

        def rows() -> pa.RecordBatch:
            nonlocal row
            score = sequence_scores(own_unit, sequences) / np.log(10)
            doc_id, out, n_tokens, n_known, base, share, rare = (pa.concat_arrays(x) for x in held)
            place = pa.array(np.arange(row, row + len(sequences)))
            row += len(sequences)
            total = pa.array(share.to_numpy() + score)
            return pa.RecordBatch.from_arrays([place, doc_id, out, n_tokens, n_known, base, total, rare], ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"])

        tokens = 0
        for batch in batches:
            for piece in slices(batch, "text"):
                found = Words(piece.column("text"))
                number, inputs = known.known(found)
                sums = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[found.bounds])  # noqa: B023, E731
                logs, in_tail = log_count[number], inputs >= WORDS
                share = np.where(in_tail, logs - log_tail[np.maximum(inputs - WORDS, 0)], 0.0)
                others = np.flatnonzero(number < 0)
                edges = np.searchsorted(others, found.bounds).astype(np.int32)
                columns = [
                    piece.column("doc_id"),
                    piece.column("held_out"),
                    pa.array(np.diff(found.bounds).astype(np.int64)),
                    pa.array(sums(number >= 0).astype(np.int64)),
                    pa.array(sums(logs)),
                    pa.array(sums(share)),
                    pa.ListArray.from_arrays(pa.array(edges), pa.array(found.keys[others].view(np.int64))),
                ]
                for kept, column in zip(held, columns):
                    kept.append(column)
                sequences += np.split(inputs, found.bounds[1:-1])
                tokens += len(inputs)
                if tokens > TOGETHER:
                    yield rows()
                    held, sequences, tokens = [[] for _ in range(7)], [], 0
        if sequences:
            yield rows()

    scored = docs.mapInArrow(score, _SCORED)
    # A row for each other word of a document; what is known of the document itself goes with the first.
    first = F.coalesce(F.col("place"), F.lit(0)) == 0
    once = [F.when(first, F.col(c)).otherwise(0).alias(c) for c in ("n_tokens", "n_known", "base", "score")]
    spread = scored.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", F.posexplode_outer("rare").alias("place", "word"))
    spread = spread.select("row", "doc_id", "held_out", *once, "word")
    joined = spread.join(counts.select("word", F.col("n").alias("count")), "word", "left")
    seen = F.log10(F.coalesce("count", F.lit(0)) + 1)
    whole = joined.groupBy("row", "doc_id", "held_out").agg(
        F.sum("n_tokens").cast("bigint").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(F.col("count").isNotNull(), 1).otherwise(0)).cast("bigint").alias("n_known"),
        F.sum(F.col("base") + seen).alias("base"),
        F.sum(F.col("score") + seen).alias("score"),
    )
    all_mass = float(np.log10(vocabulary.tokens + vocabulary.distinct + 1))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * all_mass).alias("base_score"),
        "score",
    )
