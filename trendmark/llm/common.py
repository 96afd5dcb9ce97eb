"""What the operators share: tables, tidy inputs, and words of a text column as arrays."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmark.session import scratch_path

ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> None:
    """Let Python workers that start from now on find this package where it is not installed."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{known}:{ROOT}".strip(":")


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def learning_row(column: str, modulus: int, held: int) -> Column:
    """True where crc32 of the id, as text, leaves another remainder than ``held``."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) != held


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column's rows, and where each row begins (one entry more than rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


# Word separators: white space, or all ASCII that is neither a digit nor a letter. 0 in a table separates.
def _lowered(separators: list[int]) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint8)
    codes[0] = 255  # no byte of a text; 0 stands for separators only
    codes[65:91] += 32
    codes[separators] = 0
    return codes


SPACES = [32, *range(9, 14)]
BY_SPACE = _lowered(SPACES)
BY_SYMBOL = _lowered([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

_BASE = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(_MIX[0])
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


#: Powers kept between calls, at most; a longer text has them made for itself.
_KEPT = 1 << 21
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(-(-n // (1 << 18)) << 18, base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if len(known) <= _KEPT:
            _POWERS[base] = known
    return known[:n]


def spans(inside: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of True begin and end (one past); none goes on from one row into the next, or over a True of ``cuts``."""
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] if cuts is None else ~inside[:-1] | cuts[1:]
    cut = offsets[:-1][offsets[:-1] < len(inside)]
    starts[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | starts[1:]
    return np.flatnonzero(starts), np.flatnonzero(last) + 1


def span_hashes(code: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of bytes, none of them empty."""
    n = len(code) + 1
    up, down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
    sums = np.cumsum(_VALUE[code] * up[: len(code)], dtype=np.uint64)
    before = np.where(begin > 0, sums[begin - 1], np.uint64(0))
    return mixed((sums[end - 1] - before) * down[begin])


def word_hashes(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and where each row's words begin (one entry more than rows)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    code = codes[data]
    begin, end = spans(code != 0, offsets)
    return span_hashes(code, begin, end), np.searchsorted(begin, offsets).astype(np.int64)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive words; entry i starts at word i."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    value = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        value = value * np.uint64(_BASE) + words[k : len(words) - size + 1 + k]
    return mixed(value + np.uint64(size))


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in pieces of about ``limit`` bytes of text; one longer text is a piece of its own."""
    if not batch.num_rows:
        return
    lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(lengths) - lengths) // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:]):
        yield batch.slice(a, b - a)
