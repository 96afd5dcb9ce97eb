"""Alignment of two tokenizers' tokens by pointer jumping.

A text's tokens by a byte-level tokenizer (A) and by a SentencePiece model (B) cover the same bytes: a space and the text. Where
tokens of both end, the text falls into groups; two tokens whose bytes overlap are linked.

1. *Tokens.* Texts are cut where neither tokenizer has a token across: A cuts by its fixed pattern, B has no piece with
   two such characters side by side. Each distinct stretch is encoded once in a worker's ``PieceTable``. The ids are written
   once, in blocks of documents.
2. *Groups.* Every token points to the farthest-right token that overlaps it. Pointers are doubled for all tokens of a block
   at once (successor of the successor) until they stay: each then points to the last token of its group.
3. *Counts.* Links are counted as pairs of ids within tasks, then over all documents. The most frequent pairs, ``FREQUENT``
   at most, go to every task; rarer ones are joined by a shuffle, in which none of them is hot.

Null and empty texts, and texts whose tokens of A or B spell other bytes, have no tokens and no groups. Every row is aligned
by itself, also rows that repeat a ``doc_id`` or have none, and counts as often as it occurs. An empty table gives no
row. Other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendmark.llm.common import SPACES, mixed, ready, slices, span_hashes, stored, utf8
from trendmark.llm.piece_table import Numbers, PieceTable
from trendmark.llm.tokens import listed, load

FREQUENT = 1 << 19
#: Distinct pairs that a task holds at most before it sends them.
_HELD = 1 << 20

# Kinds of bytes: white space, ASCII letters, digits and other marks, parts of longer characters.
_WHITE, _LETTER, _DIGIT, _MARK, _LONG = range(5)
_KIND = np.full(256, _LONG, np.uint8)
_KIND[:128] = _MARK
_KIND[SPACES] = _WHITE
_KIND[48:58] = _DIGIT
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
# White space beyond ASCII, in UTF-8.
_LONG_WHITE = [int.from_bytes(chr(c).encode()) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
# Fixed value: how the byte-level tokenizer cuts.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
#: A byte-level vocabulary writes these bytes as themselves in Latin-1, all others from 256 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


class ByteTokenizer:
    """A: ids and token bytes of a byte-level tokenizer; strings of special tokens are plain text."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            plan = json.load(file)
        self.by_piece = plan["normalizer"] is None and plan["pre_tokenizer"] == _BYTE_LEVEL
        hidden = [b for b in range(256) if b not in set(_VISIBLE)]
        byte_of = {chr(b): b for b in _VISIBLE} | {chr(256 + i): b for i, b in enumerate(hidden)}
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes[number] = bytes(map(byte_of.__getitem__, token)) if all(c in byte_of for c in token) else token.encode()

    def ids(self, pieces: list[str]) -> list[list[int]]:
        # A letter run with at most one space before it is one word of the pattern: the model alone is enough.
        plain = [self.by_piece and p.isascii() and p[p.startswith(" ") :].isalpha() for p in pieces]
        others = [p for p, own in zip(pieces, plain) if not own]
        encoded = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False) if others else [])
        tokenize = self.tokenizer.model.tokenize
        return [[t.id for t in tokenize(p.replace(" ", "Ġ"))] if own else next(encoded).ids for p, own in zip(pieces, plain)]


class PieceTokenizer:
    """B: ids and token bytes of a SentencePiece model."""

    def __init__(self, path: str):
        model = self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in range(len(model))]
        pieces = [self.bytes[i] for i in range(len(model)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        #: Bytes that some piece holds after its first one, and kinds that stand side by side in some piece.
        self.inner, self.beside = np.zeros(256, bool), np.zeros((5, 5), bool)
        for own in pieces:
            codes = np.frombuffer(own, np.uint8)
            after_space = codes[:-1] == ord(" ")
            self.inner[codes[1:][~((codes[1:] == ord(" ")) & after_space)]] = True
            self.beside[_KIND[codes[:-1]], _KIND[codes[1:]]] = True
        # Before every text the model puts a space; a line break, which joins nothing, keeps it off the text.
        self.by_piece = not any(b"\n" in own for own in pieces)
        self.before = len(model.encode("\n"))

    def ids(self, pieces: list[str]) -> list[list[int]]:
        if not self.by_piece:
            return [self.model.encode(p[1:]) for p in pieces]  # whole texts, with the space the model adds
        return [ids[self.before :] for ids in self.model.encode(["\n" + p for p in pieces], num_threads=1)]


class Tokenizers:
    """Both tokenizers, and what they gave for stretches of text seen before."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteTokenizer(byte_path), PieceTokenizer(piece_path)
        self.by_piece = self.a.by_piece and self.b.by_piece
        self.seen = PieceTable(self._values, kinds=3)
        self.length_a, self.length_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))

    def _values(self, pieces: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        texts = [p.decode() for p in pieces]
        a, b = self.a.ids(texts), self.b.ids(texts)
        same = [self.spell(x, y) == (p, p) for x, y, p in zip(a, b, pieces)]
        return [listed(a), listed(b), (np.ones(len(same), np.int64), np.array(same, np.int32))]

    def spell(self, a: list[int], b: list[int]) -> tuple[bytes, bytes]:
        return b"".join(map(self.a.bytes.__getitem__, a)), b"".join(map(self.b.bytes.__getitem__, b))

    def _cuts(self, data: np.ndarray) -> np.ndarray:
        """Where a new stretch may begin inside a text."""
        cuts = np.zeros(len(data), bool)
        if not self.by_piece or len(data) < 2:
            return cuts
        kind = _KIND[data]
        before, after = kind[:-1], kind[1:]
        ascii_kinds = (before != after) & (before != _WHITE) & (before != _LONG) & (after != _WHITE) & (after != _LONG)
        cuts[1:] = ascii_kinds & ~((data[:-1] == ord("'")) & (after == _LETTER)) & ~self.b.beside[before, after]
        white = np.flatnonzero((after == _WHITE) & (before != _WHITE) & ~self.b.inner[data[1:]]) + 1
        doubtful = white[kind[white - 1] == _LONG]
        code = np.zeros(len(doubtful), np.int64)
        for back in (3, 2, 1):
            code = code << 8 | np.where(doubtful >= back, data[np.maximum(doubtful - back, 0)], 0)
        cuts[white] = True
        cuts[doubtful[np.isin(code, _LONG_WHITE) | np.isin(code & 0xFFFF, _LONG_WHITE)]] = False
        return cuts

    def tokens(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids by A and where each text's begin, and the same by B."""
        spaced = pa.compute.binary_join_element_wise(pa.scalar(" "), column.fill_null(""), pa.scalar(""))
        data, offsets = utf8(spaced)
        starts = self._cuts(data)
        starts[offsets[:-1]] = True  # every text begins with its space
        begin = np.flatnonzero(starts)
        end = np.append(begin[1:], len(data))
        bounds = np.searchsorted(begin, offsets)
        entries = self.seen.entries(span_hashes(data, begin, end), data, begin, end)
        same = self.seen.lists[2].gather(entries)[1].astype(bool)
        (na, a), (nb, b) = (self.seen.lists[i].gather(entries) for i in (0, 1))
        at_a, at_b = (np.concatenate(([0], np.cumsum(n)))[bounds] for n in (na, nb))
        without = np.diff(offsets) == 1
        odd = np.unique(np.searchsorted(bounds, np.flatnonzero(~same), side="right") - 1)
        for row in odd.tolist():
            text = data[offsets[row] : offsets[row + 1]].tobytes()
            without[row] |= self.spell(a[at_a[row] : at_a[row + 1]].tolist(), b[at_b[row] : at_b[row + 1]].tolist()) != (text, text)
        out = []
        for ids, at in ((a, at_a), (b, at_b)):
            size = np.diff(at)
            out += [ids[np.repeat(~without, size)], np.concatenate(([0], np.cumsum(np.where(without, 0, size))))]
        return tuple(out)


@lru_cache(maxsize=1)
def tokenizers(byte_path: str, piece_path: str) -> Tokenizers:
    return Tokenizers(byte_path, piece_path)


class Aligned:
    """Links and groups of the tokens of some texts, laid end to end over their bytes."""

    def __init__(self, length_a: np.ndarray, length_b: np.ndarray):
        self.end_a, self.end_b = np.cumsum(length_a), np.cumsum(length_b)
        # The token that holds each byte.
        holds_a, holds_b = np.repeat(np.arange(len(length_a), dtype=np.int32), length_a), np.repeat(np.arange(len(length_b), dtype=np.int32), length_b)
        self.first, self.last = holds_b[self.end_a - length_a], holds_b[self.end_a - 1]  # of B, for each of A
        self.over_b = holds_a[self.end_b - 1]  # of A, over the last byte of each of B

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Every link as a token of A and a token of B."""
        many = self.last - self.first + 1
        a = np.repeat(np.arange(len(many), dtype=np.int32), many)
        b = np.arange(len(a), dtype=np.int32) - np.repeat((np.cumsum(many) - many - self.first).astype(np.int32), many)
        return a, b

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """The last token of A in the group of each token of A, and of each of B, by pointer jumping."""
        n = len(self.end_a)
        own = np.arange(n, dtype=np.int32)
        # Successors: the farthest token over one's last byte, of the other side; a token that ends with it stays put.
        to = np.concatenate((np.where(self.end_b[self.last] > self.end_a, self.last + np.int32(n), own), self.over_b))
        while True:
            farther = to[to]
            if np.array_equal(farther, to):
                return to[:n], to[n:]
            to = farther


def group_texts(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of all texts end to end, each text ended by ``;``, and where each begins."""
    ids = np.concatenate((a, b)).astype(np.int64)
    group = np.concatenate((group_a, group_b))
    side = np.repeat(np.array([0, 1], np.int8), [len(a), len(b)])
    order = np.argsort(group.astype(np.int64) * 2 + side, kind="stable")
    ids, group, side = ids[order], group[order], side[order]
    mark = np.full(len(ids), ord(";"), np.uint8)
    mark[:-1][group[1:] == group[:-1]] = ord("|")
    mark[:-1][(group[1:] == group[:-1]) & (side[1:] == side[:-1])] = ord(",")
    digits = len(str(int(ids.max(initial=0))))
    tens = 10 ** np.arange(digits, dtype=np.int64)
    size = np.maximum(1, np.searchsorted(tens, ids, side="right"))
    ends = np.cumsum(size + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = mark
    rest = ids
    for place in range(digits):
        here = size > place
        out[(ends - 2 - place)[here]] = (48 + rest % 10).astype(np.uint8)[here]
        rest = rest // 10
    written = np.concatenate(([0], ends))
    return out.tobytes(), written[at_a + at_b]


class Blocks:
    """How written tokens are read: the number of bytes of each id, and the width of the ids."""

    def __init__(self, length_a: np.ndarray, length_b: np.ndarray):
        self.length_a, self.length_b = length_a, length_b
        self.kinds = [np.uint16 if len(n) <= 1 << 16 else np.int32 for n in (length_a, length_b)]

    def read(self, batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, Aligned]:
        a, b = (np.frombuffer(batch.column(c)[row].as_buffer(), kind).astype(np.int64) for c, kind in zip("ab", self.kinds))
        return a, b, Aligned(self.length_a[a], self.length_b[b])

    def codes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * len(self.length_b) + b


def _keys(codes: np.ndarray) -> np.ndarray:
    return np.maximum(mixed(codes.astype(np.uint64) + np.uint64(1)), np.uint64(1))


class Alignment:
    """Tokens of all rows of ``docs`` by both tokenizers, written once; what is asked is computed from these."""

    def __init__(self, docs: DataFrame, byte_path: str, piece_path: str, frequent: int = FREQUENT):
        ready(docs.sparkSession)
        self.spark, self.frequent = docs.sparkSession, frequent
        both = Tokenizers(byte_path, piece_path)
        self.layout = Blocks(both.length_a, both.length_b)
        kinds = self.layout.kinds

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = tokenizers(byte_path, piece_path)
            for batch in batches:
                for piece in slices(batch, "text"):
                    a, at_a, b, at_b = own.tokens(piece.column("text"))
                    values = [[piece.column("key").to_pylist()], [piece.column("doc_id").to_pylist()], [at_a], [at_b], [a.astype(kinds[0]).tobytes()], [b.astype(kinds[1]).tobytes()]]
                    types = [pa.list_(pa.int64())] * 4 + [pa.binary()] * 2
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], ["key", "doc_id", "at_a", "at_b", "a", "b"])

        keyed = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("bigint"), "text")
        schema = "key array<bigint>, doc_id array<bigint>, at_a array<bigint>, at_b array<bigint>, a binary, b binary"
        self.blocks = stored(keyed.mapInArrow(encode, schema), "tokens", "zstd")

    def pair_counts(self) -> DataFrame:
        """code (a * size of B's vocabulary + b), n (links of these ids in all documents), best (none of b's has more)."""

        layout = self.layout

        def merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            code, n = np.concatenate(codes), np.concatenate(counts)
            order = np.argsort(code, kind="stable")
            code, n = code[order], n[order]
            first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
            return code[first], np.add.reduceat(n, first)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codes, counts, held = [], [], 0
            send = lambda: pa.RecordBatch.from_arrays([pa.array(codes[0]), pa.array(counts[0])], ["code", "n"])
            for batch in batches:
                for row in range(batch.num_rows):
                    a, b, aligned = layout.read(batch, row)
                    i, j = aligned.links()
                    code, n = np.unique(layout.codes(a[i], b[j]), return_counts=True)
                    codes.append(code)
                    counts.append(n)
                    held += len(code)
                    if held > _HELD:
                        codes, counts = ([x] for x in merged(codes, counts))
                        held = len(codes[0]) if 2 * len(codes[0]) <= _HELD else 0
                        if not held:
                            yield send()
                            codes, counts = [], []
            if held:
                codes, counts = ([x] for x in merged(codes, counts))
                yield send()

        n = self.blocks.select("a", "b").mapInArrow(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
        # Pairs of one id of B: at most as many as A has ids.
        most = F.max("n").over(Window.partitionBy(F.pmod("code", F.lit(len(layout.length_b)))))
        return n.withColumn("best", F.col("n") == most)

    def _least(self) -> int:
        """The count from which on pairs are frequent: at most ``frequent`` pairs reach it."""
        step = F.floor(8 * F.log2("n"))  # a few hundred steps, whatever the counts
        steps = self.pairs.groupBy(step.alias("step")).agg(F.count("*").alias("pairs"), F.min("n").alias("least")).collect()
        least, held = 1 << 62, 0
        for row in sorted(steps, key=lambda r: -r["step"]):
            held += row["pairs"]
            if held > self.frequent:
                break
            least = row["least"]
        return least

    def groups(self) -> DataFrame:
        """key, doc_id, n_a, n_b, n_groups, n_links and the groups of each row as text, with the counts of frequent pairs
        summed (known_best, known_sum) and the rare pairs listed; ``with_counts`` completes them."""
        self.pairs = stored(self.pair_counts(), "pairs")
        top = self.pairs.filter(F.col("n") >= self._least()).toArrow()
        layout = self.layout
        numbers = Numbers(max(1, top.num_rows))
        numbers.add(_keys(top["code"].to_numpy()))
        shared = self.spark.sparkContext.broadcast((numbers, np.append(top["n"].to_numpy(), 0), np.append(top["best"].to_numpy().astype(bool), False)))

        def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers, n, best = shared.value
            for batch in batches:
                for row in range(batch.num_rows):
                    a, b, aligned = layout.read(batch, row)
                    key, doc_id = (batch.column(c).slice(row, 1).flatten() for c in ("key", "doc_id"))
                    at_a, at_b = (np.asarray(batch.column(c).slice(row, 1).flatten()) for c in ("at_a", "at_b"))
                    group_a, group_b = aligned.groups()
                    text, starts = group_texts(a, b, at_a, at_b, group_a, group_b)
                    i, j = aligned.links()
                    at_link = np.searchsorted(i, at_a)
                    code = layout.codes(a[i], b[j])
                    found = numbers.find(_keys(code))
                    sums = lambda x, at: np.diff(np.concatenate(([0], np.cumsum(x)))[at])
                    rare = np.flatnonzero(found < 0)
                    texts = [text[x : max(x, y - 1)] for x, y in zip(starts[:-1].tolist(), starts[1:].tolist())]
                    columns = [
                        np.diff(at_a),
                        np.diff(at_b),
                        sums(group_a == np.arange(len(a)), at_a),
                        np.diff(at_link),
                        sums(best[found], at_link),
                        sums(n[found], at_link),
                    ]
                    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(rare, at_link).astype(np.int32)), pa.array(code[rare]))
                    yield pa.RecordBatch.from_arrays(
                        [key, doc_id, *(pa.array(c.astype(np.int64)) for c in columns), pa.array(texts, pa.binary()).cast(pa.string()), lists],
                        ["key", "doc_id", "n_a", "n_b", "n_groups", "n_links", "known_best", "known_sum", "groups", "rare"],
                    )

        schema = "key bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, known_best bigint, known_sum bigint, groups string, rare array<bigint>"
        return self.blocks.mapInArrow(describe, schema)

    def with_counts(self, rows: DataFrame) -> DataFrame:
        """``rows`` of ``groups`` with n_best and count_sum over all pairs, frequent and rare."""
        rows = stored(rows, "aligned")
        rare = rows.select("key", F.explode("rare").alias("code")).join(self.pairs, "code")
        sums = rare.groupBy("key").agg(F.count_if("best").alias("rare_best"), F.sum("n").alias("rare_sum"))
        whole = lambda known, more: (F.col(known) + F.coalesce(F.col(more), F.lit(0))).alias
        kept = [c for c in rows.columns if c not in ("key", "rare", "known_best", "known_sum")]
        return rows.join(sums, "key", "left").select(*kept, whole("known_best", "rare_best")("n_best"), whole("known_sum", "rare_sum")("count_sum"))
