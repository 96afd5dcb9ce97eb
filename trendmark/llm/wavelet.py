"""Token-ID files as wavelet matrices.

Texts are tokenized in order of their ids and cut into shards of whole documents. A shard is one row of a Parquet
part file: its documents, where each begins, and the wavelet matrix of its token ids: one plane of bits
for each bit of an id, highest first; after each plane the ids with a 0 go before those with a 1, order kept. Ranks
are kept for every ``BLOCK`` bits. From that row alone tokens can be read, counted and located.

Null and empty texts have the end id alone. Rows sort by doc_id, null ids first; rows of one id, in a fixed order, are
documents of their own. An empty table gives an empty file. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendmark.llm.common import ready, slices
from trendmark.llm.tokens import load, word_tokenizer

#: Ids in a shard, about; a longer document has a shard of its own.
SHARD = 1 << 20
BLOCK = 512
BITS = 16

_FIELDS = {
    "part": pa.int32(),
    "number": pa.int32(),
    "before": pa.int64(),
    "n": pa.int64(),
    "doc_ids": pa.list_(pa.int64()),
    "starts": pa.list_(pa.int64()),
    "zeros": pa.list_(pa.int64()),
    "planes": pa.list_(pa.binary()),
    "ranks": pa.list_(pa.binary()),
}
_SCHEMA = "part int, number int, before bigint, n bigint, doc_ids array<bigint>, starts array<bigint>, zeros array<bigint>, planes array<binary>, ranks array<binary>"


class WaveletMatrix:
    """Ids with random access, counts and places of a symbol, over packed bit planes."""

    def __init__(self, n: int, zeros: list[int], planes: list[bytes], ranks: list[bytes]):
        self.n, self.zeros = n, zeros
        self.planes = [np.frombuffer(p, np.uint8) for p in planes]
        self.ranks = [np.frombuffer(r, np.uint32) for r in ranks]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int = BITS) -> WaveletMatrix:
        zeros, planes, ranks = [], [], []
        for shift in range(bits - 1, -1, -1):
            ones = (ids >> shift) & 1 == 1
            low, high = ids.take(np.flatnonzero(~ones)), ids.take(np.flatnonzero(ones))
            packed = np.packbits(ones, bitorder="little")
            whole = np.zeros(-(-len(packed) * 8 // BLOCK) * (BLOCK // 64) + 1, np.uint64)
            whole.view(np.uint8)[: len(packed)] = packed
            per_block = np.bitwise_count(whole[:-1]).reshape(-1, BLOCK // 64).sum(1)
            ranks.append(np.concatenate(([0], np.cumsum(per_block))).astype(np.uint32).tobytes())
            planes.append(packed.tobytes())
            zeros.append(len(low))
            ids = np.concatenate((low, high))
        return cls(len(ids), zeros, planes, ranks)

    def bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (i & 7)) & 1

    def rank(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block = i // BLOCK
        part = self.planes[level][block * BLOCK // 8 : -(-i // 8)]
        return int(self.ranks[level][block]) + int(np.unpackbits(part, bitorder="little")[: i - block * BLOCK].sum())

    def select(self, level: int, one: int, k: int) -> int:
        """Place of the k-th (from 0) bit of a plane that is ``one``."""
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if one else np.arange(len(ranks)) * BLOCK - ranks
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == one)[k - int(before[block])])

    def access(self, i: int) -> int:
        symbol = 0
        for level in range(len(self.planes)):
            ones = self.rank(level, i)
            if self.bit(level, i):
                symbol, i = symbol << 1 | 1, self.zeros[level] + ones
            else:
                symbol, i = symbol << 1, i - ones
        return symbol

    def _range(self, symbol: int, a: int, b: int) -> tuple[int, int]:
        """Where a symbol's occurrences among places a to b stand after the last plane."""
        for level in range(len(self.planes)):
            x, y = self.rank(level, a), self.rank(level, b)
            if symbol >> (len(self.planes) - 1 - level) & 1:
                a, b = self.zeros[level] + x, self.zeros[level] + y
            else:
                a, b = a - x, b - y
        return a, b

    def count(self, symbol: int, a: int = 0, b: int | None = None) -> int:
        a, b = self._range(symbol, a, self.n if b is None else b)
        return b - a

    def locate(self, symbol: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of a symbol."""
        a, b = self._range(symbol, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for level in range(len(self.planes) - 1, -1, -1):
            one = symbol >> (len(self.planes) - 1 - level) & 1
            i = self.select(level, one, i - self.zeros[level] if one else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids, plane by plane from the last."""
        ids = np.zeros(self.n, np.uint32 if len(self.planes) > 16 else np.uint16)
        for level in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            out = np.empty_like(ids)
            out[np.flatnonzero(~ones)] = ids[: self.zeros[level]]
            out[np.flatnonzero(ones)] = ids[self.zeros[level] :] | ids.dtype.type(1 << (len(self.planes) - 1 - level))
            ids = out
        return ids


def write_shards(docs: DataFrame, target: str, path: str, end: int = 2, shard: int = SHARD) -> None:
    """Write ``docs`` (doc_id, text) as shards under the folder ``target``."""
    ready(docs.sparkSession)
    bits = max(load(path).get_vocab_size() - 1, end).bit_length()

    def row(number: int, before: int, doc_ids: list, tokens: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(tokens)
        matrix = WaveletMatrix.build(every, bits)
        starts = np.cumsum([0, *map(len, tokens)])[:-1]
        values = [TaskContext.get().partitionId(), number, before, len(every), doc_ids, starts, matrix.zeros]
        values += [[p.tobytes() for p in matrix.planes], [r.tobytes() for r in matrix.ranks]]
        return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(values, _FIELDS.values())], list(_FIELDS))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, tokens, number, before, held = [], [], 0, 0, 0
        for batch in batches:
            for piece in slices(batch, "text"):
                ids, bounds = word_tokenizer(path).ids(piece.column("text"), end)
                ids = ids.astype(np.uint16 if bits <= 16 else np.uint32)
                for doc_id, a, b in zip(piece.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    if tokens and held + b - a > shard:
                        yield row(number, before, doc_ids, tokens)
                        doc_ids, tokens, number, before, held = [], [], number + 1, before + held, 0
                    doc_ids.append(doc_id)
                    tokens.append(ids[a:b])
                    held += b - a
        if tokens:
            yield row(number, before, doc_ids, tokens)

    # A third of all rows may have one id: its rows are told apart by text and place.
    order = ["doc_id", "by_text", "by_place"]
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("by_text"), F.monotonically_increasing_id().alias("by_place"))
    in_order = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    in_order.mapInArrow(build, _SCHEMA).write.option("compression", "zstd").parquet(target)


def read_documents(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the shards under ``target``, from their planes."""
    ready(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                shard = batch.slice(r, 1).to_pylist()[0]
                ids = WaveletMatrix(shard["n"], shard["zeros"], shard["planes"], shard["ranks"]).decode()
                starts = [*shard["starts"], shard["n"]]
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts[:-1], starts[1:])]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard["part"]] * n, pa.int32()),
                        pa.array(shard["doc_ids"], pa.int64()),
                        pa.array(np.array(starts[:-1], np.int64) + shard["before"]),
                        pa.array(np.diff(starts).astype(np.int64)),
                        pa.array(crc, pa.int64()),
                    ],
                    ["part", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    shards = spark.read.schema(_SCHEMA).parquet(target)
    rows = shards.mapInArrow(read, "part int, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part file
    parts = shards.groupBy("part").agg(F.sum("n").alias("total"))
    parts = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("earlier"))
    return rows.join(parts, "part").select(
        "doc_id", (F.col("earlier") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )
