"""A public tokenizer of the ``tokenizers`` library inside tasks, with a cache of the pieces it has seen.

Both vocabularies used here treat text between white space on its own: a run of white space with the word after it
(byte-level) or a word (white space dropped) has the same tokens wherever it stands. Pieces are looked up in a
cache and all misses of a batch are encoded by the library in one call. ``Cache`` holds two generations of about
``LIMIT`` pieces each; ``WordTokenizer`` looks pieces up in a ``PieceTable``. A worker keeps both between tasks.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from trendmark.llm.common import SPACES, span_hashes, spans, utf8
from trendmark.llm.piece_table import PieceTable

# The white space of the tokenizers' patterns.
WHITE = " \t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS_WITH_SPACE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")

LIMIT = 400_000
#: Longer pieces are encoded each time; they would fill a cache with text that hardly comes again.
LONGEST = 64

_CACHES: dict[tuple, "Cache"] = {}


def load(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


class Cache:
    """Values of pieces: those given at the start, and what was encoded since; those not used
    while ``LIMIT`` others were are forgotten: a full generation becomes the older one, and what is still asked for moves on."""

    def __init__(self, path: str, value: Callable, frequent: dict[str, object]):
        self.tokenizer = load(path)
        self.value, self.frequent = value, frequent
        self.known, self.older = dict(frequent), {}

    def encoded(self, pieces: list[str]) -> list:
        return [self.value(e.ids) for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def lookup(self, pieces: set[str]) -> Callable[[str], object]:
        """A function from each of ``pieces`` to its value."""
        if len(self.known) > LIMIT:
            self.known, self.older = dict(self.frequent), self.known
        missing = pieces - self.known.keys()
        again = missing & self.older.keys()
        self.known.update((p, self.older[p]) for p in again)
        missing -= again
        long = [p for p in missing if len(p) > LONGEST]
        short = [p for p in missing if len(p) <= LONGEST]
        self.known.update(zip(short, self.encoded(short)))
        if not long:
            return self.known.__getitem__
        extra = dict(zip(long, self.encoded(long)))
        return lambda p: extra[p] if p in extra else self.known[p]


def cache(path: str, label: str, value: Callable, frequent: dict[str, object] | None = None) -> Cache:
    """This worker's cache for a tokenizer file."""
    key = (path, label)
    if key not in _CACHES or (frequent is not None and _CACHES[key].frequent is not frequent and _CACHES[key].frequent != frequent):
        _CACHES[key] = Cache(path, value, frequent or {})
    return _CACHES[key]


def listed(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of some lists, and the lists end to end."""
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    return lengths, np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))


# How the word tokenizer prepares a text.
WORD_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Kinds of bytes: white space, ASCII letters, digits and all other ASCII, parts of longer characters.
_WHITE, _LETTER, _DIGIT, _MARK, _LONG = range(5)
_KIND = np.full(256, _LONG, np.uint8)
_KIND[:128] = _MARK
_KIND[SPACES] = _WHITE
_KIND[48:58] = _DIGIT
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class WordTokenizer:
    """Ids of texts by a tokenizer that lower-cases, drops white space and cuts words by kind of character.

    Texts are cut where this tokenizer's pattern always cuts: at ASCII white space, and between two ASCII characters
    of different kinds or two digits, but not after an apostrophe, which may begin a contraction. Pieces of ASCII letters
    alone are lower-cased and given to the tokenizer's model, all others to the library as they stand. Where a text
    of a batch holds a special token's string, that batch is cut at white space only. A tokenizer with another
    pattern encodes whole texts.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        with open(path, encoding="utf-8") as file:
            plan = json.load(file)
        self.special = [t["content"].encode() for t in plan["added_tokens"]]
        splits = (plan["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        self.by_piece = (plan["normalizer"] or {}).get("normalizers") == WORD_NORMALIZER and splits[0].get("pattern") == {"Regex": WORD_PATTERN}
        self.pieces = PieceTable(self._values)

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _values(self, pieces: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        tokenize = self.tokenizer.model.tokenize
        plain = [p.isalpha() and p.islower() for p in pieces]  # of bytes: ASCII letters only
        others = iter(self._encoded([p.decode() for p, own in zip(pieces, plain) if not own]))
        return [listed([[t.id for t in tokenize(p.decode())] if own else next(others) for p, own in zip(pieces, plain)])]

    def ids(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, each followed by ``end``, and where each text's begin (one entry more than texts)."""
        if not self.by_piece:
            lengths, ids = listed([[*own, end] for own in self._encoded([t or "" for t in column.to_pylist()])])
            return ids, np.concatenate(([0], np.cumsum(lengths)))
        data, offsets = utf8(column)
        kind = _KIND[data]
        whole = data.tobytes()
        if any(s in whole for s in self.special):
            begin, stop = spans(kind != _WHITE, offsets)
        else:
            cuts = np.zeros(len(data), bool)
            before, after = kind[:-1], kind[1:]
            cuts[1:] = (before != after) & (before != _LONG) & (after != _LONG) & ~((data[:-1] == ord("'")) & (after == _LETTER))
            cuts[1:] |= (before == _DIGIT) & (after == _DIGIT)
            begin, stop = spans(kind != _WHITE, offsets, cuts)
            longer = np.concatenate(([0], np.cumsum(kind == _LONG)))
            kept = np.zeros(len(data) + 1, np.int8)  # 1 inside pieces that are not of ASCII alone
            odd = longer[stop] > longer[begin]
            np.add.at(kept, begin[odd], 1)
            np.add.at(kept, stop[odd], -1)
            data = np.where(np.cumsum(kept[:-1], dtype=np.int8) > 0, data, _LOWER[data])
        bounds = np.searchsorted(begin, offsets)
        entries = np.zeros(0, np.int32)
        if len(begin):
            entries = self.pieces.entries(span_hashes(data, begin, stop), data, begin, stop)
        lengths, ids = self.pieces.lists[0].gather(entries)
        first = np.concatenate(([0], np.cumsum(lengths)))[bounds]  # ids before each text, without ends
        return np.insert(ids, first[1:], end), first + np.arange(len(first))


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """This worker's tokenizer of a file, with what it has seen."""
    return WordTokenizer(path)
