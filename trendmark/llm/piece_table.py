"""Values of text pieces, looked up for whole batches at once.

A piece is known by its 64-bit hash; its value is a list of integers, or several lists. Lists lie end to end in flat
arrays, hashes in an open-addressed table, so that a batch costs some array operations and only pieces that were not
seen before cost a call each. The table is bounded in pieces and in integers and starts anew when it is full; what it
holds changes speed, never results.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

PIECES = 1 << 19
ROOM = 1 << 22


class Numbers:
    """Numbers from 0 for 64-bit keys other than 0, which are spread evenly; open addressing."""

    def __init__(self, most: int):
        size = 1 << (2 * most - 1).bit_length()
        self.keys, self.number, self.n = np.zeros(size, np.uint64), np.zeros(size, np.int32), 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where it has none."""
        out = np.full(len(keys), -1, np.int32)
        last = len(self.keys) - 1
        left, place = np.arange(len(keys)), (keys & np.uint64(last)).astype(np.int64)
        while len(left):
            held = self.keys[place]
            same = held == keys[left]
            out[left[same]] = self.number[place[same]]
            on = ~same & (held != 0)
            left, place = left[on], (place[on] + 1) & last
        return out

    def add(self, keys: np.ndarray) -> None:
        """Give the next numbers to keys that have none."""
        last = len(self.keys) - 1
        number, place = self.n + np.arange(len(keys)), (keys & np.uint64(last)).astype(np.int64)
        self.n += len(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[place] == 0)
            _, first = np.unique(place[free], return_index=True)
            taken = free[first]
            self.keys[place[taken]], self.number[place[taken]] = keys[taken], number[taken]
            rest = np.ones(len(keys), bool)
            rest[taken] = False
            keys, number, place = keys[rest], number[rest], (place[rest] + 1) & last


class Lists:
    """Lists of integers, end to end."""

    def __init__(self) -> None:
        self.flat, self.starts, self.n = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int32), 0

    @property
    def used(self) -> int:
        return int(self.starts[self.n])

    def extend(self, lengths: np.ndarray, values: np.ndarray) -> None:
        used, n = self.used, self.n + len(lengths)
        if n >= len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros(max(n, len(self.starts)), np.int32)))
        if used + len(values) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(max(len(values), len(self.flat)), np.int32)))
        self.starts[self.n + 1 : n + 1] = used + np.cumsum(lengths)
        self.flat[used : used + len(values)] = values
        self.n = n

    def lengths(self, entries: np.ndarray) -> np.ndarray:
        return (self.starts[entries + 1] - self.starts[entries]).astype(np.int64)

    def gather(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lengths of some lists, and these lists end to end."""
        lengths = self.lengths(entries)
        ends = np.cumsum(lengths)
        places = np.repeat(self.starts[entries] - (ends - lengths), lengths)
        places += np.arange(len(places))
        return lengths, self.flat[places]


class PieceTable:
    """``values`` makes, for some pieces, the lengths and the integers of each of ``kinds`` lists."""

    def __init__(self, values: Callable[[list[bytes]], list[tuple[np.ndarray, np.ndarray]]], kinds: int = 1, pieces: int = PIECES, room: int = ROOM):
        self.values, self.kinds, self.pieces, self.room = values, kinds, pieces, room
        self._clear(pieces)

    def _clear(self, most: int) -> None:
        self.most, self.numbers = most, Numbers(most)
        self.lists = [Lists() for _ in range(self.kinds)]

    def entries(self, hashes: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of each piece, stretches of the bytes ``data`` with these hashes; entries hold until the next call."""
        keys = np.maximum(hashes, np.uint64(1))
        if self.most > self.pieces or max(own.used for own in self.lists) > self.room:
            self._clear(self.pieces)
        found = self.numbers.find(keys)
        missing = np.flatnonzero(found < 0)
        if not len(missing):
            return found
        new, first = np.unique(keys[missing], return_index=True)
        if self.numbers.n + len(new) > self.most:
            new, first = np.unique(keys, return_index=True)
            self._clear(max(self.pieces, len(new)))
            missing = np.arange(len(keys))
        of = missing[first]
        text = data.tobytes()
        made = self.values([text[a:b] for a, b in zip(begin[of].tolist(), end[of].tolist())])
        self.numbers.add(new)
        for own, (lengths, values) in zip(self.lists, made):
            own.extend(lengths, values)
        found[missing] = self.numbers.find(keys[missing])
        return found
