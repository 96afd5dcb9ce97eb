"""Exact Jaccard join of documents on sets of word shingles, by T-occurrence search.

Two documents link when ``100 * |r & s| >= percent * |r | s|``. A document with n shingles then shares at
least T = ceil(n * percent / 100) of them with each document it links to. The join runs in these steps:

1. *Shared shingles.* A document may have n - T shingles at most that no other has. Three eighths of all
   shingles, those with the smallest hashes, are counted: a document without any copy exceeds n - T already among these,
   and the join ends there for it. Tasks count within a batch of documents and send each distinct shingle once,
   so that a shingle of a third of all documents still counts once for each batch.
2. *Classes.* Candidates with equal sets form one class; its smallest id stands for it.
3. *Short lists.* A class needs one of its n - T + 1 rarest shingles in common with each class it links to.
   Documents that meet in such an inverted list fall into one cluster.
4. *T-occurrence search with DivideSkip* inside each cluster, by inverted lists over its documents: a
   query's longest lists are set aside, the short ones are merged and counted, and documents that reach the
   required overlap less the lists set aside are probed for those by binary search. Large clusters are cut into
   chunks and every pair of chunks is a task of its own; links between documents already joined in a task
   are not looked for again, as only their component matters.
5. *Components* of the links by label propagation over Spark joins.

Rows are told apart by a key of their own, given when they are first written; ids are looked up at the end. So
every row is judged by its own text, also where several share a ``doc_id`` or have none, and every row is in the result. A
component is named by its smallest ``doc_id``, or null if none of its rows has one.

Shingles are compared by 64-bit hashes. Null, empty and wordless texts have no shingle, link with nothing and
are components of their own. With fewer words than a shingle, the whole sequence is the one shingle. Repeated
rows are in one class. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmark.llm.common import BY_SPACE, ready, run_hashes, slices, stored, utf8, word_hashes
from trendmark.operators.broadcasting import broadcast_if_small

SHINGLE = 5
PERCENT = 75
#: Shingles that one bucket of the count receives, about.
BUCKET = 8_000_000
#: Eighths of the shingles, by hash, that are counted.
COUNTED = 3
#: Shingles of the documents in one chunk of a cluster, about.
CHUNK = 1_000_000
#: Short lists with so many entries at most are merged with a heap; more are counted by document at once.
HEAP = 512
#: Entries of long lists that take as long as probing one document.
PROBE = 4_000
#: A class or component with so many rows is not gathered in one task to be named.
HOT = 1_000


def shingle_sets(words: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each row."""
    runs = run_hashes(words, size)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            found = np.sort(runs[a : b - size + 1])
            sets.append(found[np.concatenate(([True], found[1:] != found[:-1]))])
        else:
            sets.append(run_hashes(words[a:b], b - a)[:1] if b > a else words[:0])
    return sets


def _piece_sets(piece: pa.RecordBatch, size: int) -> list[np.ndarray]:
    sets: list[np.ndarray] = []
    for part in slices(piece, "text"):  # hashing needs some thirty times the bytes of its texts
        sets += shingle_sets(*word_hashes(*utf8(part.column("text")), BY_SPACE), size)
    return sets


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """T: shingles that a set of n shares with any set it links to."""
    return -(-n * percent // 100)


_SENT = pa.schema([("bucket", pa.int64()), ("ids", pa.binary()), ("rows", pa.binary()), ("codes", pa.binary())])


def _sent(docs: DataFrame, size: int, buckets: int) -> DataFrame:
    """Shingles of a batch of documents, a row for each bucket of shingles.

    ``codes`` are low halves of shingles, ``ids`` documents, ``rows`` the place in ``ids`` of each code's
    document; one past the end stands for several documents. Negative buckets carry, for each document,
    its number of shingles (``codes``), and those counted here that are not known to be shared (``rows``).
    """

    top = np.uint64(COUNTED << 61)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 60_000):
                for piece in slices(batch.slice(start, 60_000), "text", 6 << 20):
                    yield pa.RecordBatch.from_pydict(pack(piece), schema=_SENT)

    def pack(piece: pa.RecordBatch) -> dict[str, list]:
        sets = _piece_sets(piece, size)
        ids = piece.column("key").to_numpy(zero_copy_only=False).astype(np.int64)
        n = np.array([len(s) for s in sets], np.int64)
        sets = [s[: int(np.searchsorted(s, top))] for s in sets]
        every = np.concatenate(sets)
        order = np.argsort(every)
        every, row = every[order], np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order]
        new = np.ones(len(every), bool)
        new[1:] = every[1:] != every[:-1]
        alone = new.copy()
        alone[:-1] &= new[1:]
        single = np.bincount(row[alone], minlength=len(sets))
        # A shingle of several documents is known as shared here; it is sent once, for other batches.
        once, row, every = alone[new], row[new], every[new]
        out = {"bucket": [-1 - int(ids[0]) % (1 << 40)], "ids": [ids.tobytes()], "rows": [single.tobytes()], "codes": [n.tobytes()]}
        # Sorted by value, so a bucket, taken from the high bits, is a run.
        limits = (np.arange(1, buckets, dtype=np.uint64) * (top >> np.uint64(32))) // np.uint64(buckets)
        edges = [0, *np.searchsorted(every >> np.uint64(32), limits).tolist(), len(every)]
        for bucket, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if a < b:
                present, place = np.unique(row[a:b][once[a:b]], return_inverse=True)
                rows = np.full(b - a, len(present), np.uint16)
                rows[once[a:b]] = place
                out["bucket"].append(bucket)
                out["ids"].append(ids[present].tobytes())
                out["rows"].append(rows.tobytes())
                out["codes"].append(every[a:b].astype(np.uint32).tobytes())
        return out

    return docs.mapInArrow(send, "bucket bigint, ids binary, rows binary, codes binary")


def _shared(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """For each document, how many of a bucket's shingles are found in another batch, with a minus."""
    if key[0] < 0:
        ids, single, n = (np.concatenate([np.frombuffer(x, np.int64) for x in rows[c]]) for c in ("ids", "rows", "codes"))
        return pd.DataFrame({"key": ids, "n": n, "single": single})
    ids = [np.frombuffer(x, np.int64) for x in rows["ids"]]
    # Each code with its document, sorted in place as one number. Documents are numbered on; 0 stands for several.
    both = np.empty(sum(len(x) for x in rows["codes"]) // 4, np.uint64)
    codes, owner = both.view(np.uint32)[1::2], both.view(np.uint32)[::2]
    at, first = 0, 1
    for code, row, own in zip(rows["codes"], rows["rows"], ids):
        row = np.frombuffer(row, np.uint16)
        codes[at : at + len(row)] = np.frombuffer(code, np.uint32)
        owner[at : at + len(row)] = np.where(row < len(own), row + np.uint32(first), 0)
        at, first = at + len(row), first + len(own)
    both.sort()
    same = codes[1:] == codes[:-1]
    shared = np.zeros(len(codes), bool)
    shared[1:] |= same
    shared[:-1] |= same
    counts = np.bincount(owner[shared], minlength=1 + sum(map(len, ids)))[1:]
    found = np.flatnonzero(counts)
    return pd.DataFrame({"key": np.concatenate(ids)[found], "n": np.zeros(len(found), np.int64), "single": -counts[found]})


def _candidate_sets(docs: DataFrame, size: int) -> DataFrame:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                found = _piece_sets(piece, size)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("key"),
                        pa.array([len(x) for x in found], pa.int64()),
                        pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in found], pa.binary()),
                        pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64())),
                    ],
                    ["key", "n", "digest", "shingles"],
                )

    return docs.mapInArrow(sets, "key bigint, n bigint, digest binary, shingles array<bigint>")


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of the graph with ``edges`` (a, b); isolated nodes have no row.

    Each round hangs all neighbours of a node on the smallest of them, first the larger neighbours, then
    the smaller, until nothing changes. Rounds are written, as the next one reads its predecessor twice.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("b", "m").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


class Lists:
    """Inverted lists over the sets of some documents."""

    def __init__(self, sets: list[np.ndarray]):
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in sets])
        order = np.argsort(every, kind="stable")
        self.owner = owner[order]
        self.keys, self.first, self.length = np.unique(every[order], return_index=True, return_counts=True)
        self.sets = sets

    def merged(self, lists: np.ndarray) -> np.ndarray:
        """All entries of some lists."""
        length = self.length[lists]
        return self.owner[np.repeat(self.first[lists] - np.cumsum(length) + length, length) + np.arange(length.sum())]

    def search(self, query: np.ndarray, least: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents among ``wanted`` that share ``least`` shingles with the query, and how many they share."""
        place = np.minimum(np.searchsorted(self.keys, query), len(self.keys) - 1)
        lists = place[self.keys[place] == query]
        none = np.zeros(0, np.int64)
        if len(lists) < least:
            return none, none
        lists = lists[np.argsort(self.length[lists], kind="stable")]
        aside = least - 1
        short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
        if self.length[short].sum() <= HEAP:
            runs = [self.owner[f : f + n].tolist() for f, n in zip(self.first[short].tolist(), self.length[short].tolist())]
            found: dict[int, int] = {}
            for document in heapq.merge(*runs):
                found[document] = found.get(document, 0) + 1
            documents, counts = np.array(list(found), np.int64), np.array(list(found.values()), np.int64)
        else:
            every = np.bincount(self.merged(short), minlength=len(self.sets))
            documents = np.flatnonzero(every)
            counts = every[documents]
        keep = wanted[documents] & (counts >= least - len(long))
        documents, counts = documents[keep], counts[keep]
        if len(long) and len(documents):
            if len(documents) * PROBE < self.length[long].sum():
                probes = self.keys[long]
                for i, document in enumerate(documents.tolist()):
                    own = self.sets[document]
                    counts[i] += np.count_nonzero(own[np.minimum(np.searchsorted(own, probes), len(own) - 1)] == probes)
            else:
                counts = counts + np.bincount(self.merged(long), minlength=len(self.sets))[documents]
        keep = counts >= least
        return documents[keep], counts[keep]


def _linked(percent: int):
    def link(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Links of a group's documents, as a star for each component found here."""
        rows = rows.sort_values(["n", "key"], kind="stable")
        ids, n, chunk = (rows[c].to_numpy(np.int64) for c in ("key", "n", "chunk"))
        sets = [np.asarray(x, np.int64).view(np.uint64) for x in rows["shingles"]]
        lists = Lists(sets)
        label = np.arange(len(sets))
        across = len(np.unique(chunk)) > 1
        for i, query in enumerate(sets):
            wanted = label != label[i]
            wanted[: i + 1] = False
            if across:
                wanted &= chunk != chunk[i]
            if not wanted.any():
                continue
            found, shared = lists.search(query, int(needed(n[i], percent)), wanted)
            for j in found[100 * shared >= percent * (n[i] + n[found] - shared)].tolist():
                if label[i] != label[j]:
                    label[label == label[j]] = label[i]
        least = pd.Series(ids).groupby(label).transform("min").to_numpy()
        return pd.DataFrame({"a": ids[ids != least], "b": least[ids != least]})

    return link


def _links(classes: DataFrame, percent: int, chunk: int) -> DataFrame:
    """Links (a, b) between classes (doc_id, n, shingles)."""
    posting = classes.select("key", "n", F.explode("shingles").alias("shingle"))
    often = posting.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1")
    rest = F.size("own") - F.ceil(F.col("n") * percent / 100)  # of shared shingles, less those always left aside
    short = (
        posting.join(often, "shingle")
        .groupBy("key", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("own"))
        .filter(rest >= 0)
        .select("key", F.explode(F.slice("own", F.lit(1), (rest + 1).cast("int"))).alias("entry"))
        .select("key", F.col("entry.shingle").alias("shingle"))
    )
    short = stored(short, "short-lists")
    hub = short.groupBy("shingle").agg(F.min("key").alias("hub"), F.count("*").alias("many")).filter("many > 1")
    meet = short.join(hub, "shingle").select(F.col("key").alias("a"), F.col("hub").alias("b")).distinct()
    clusters = components(meet)
    clusters = clusters.unionByName(clusters.select(F.col("component").alias("node"), "component").distinct())
    members = stored(classes.join(clusters.withColumnRenamed("node", "key"), "key"), "members")
    sizes = members.groupBy("component").agg(F.ceil(F.sum("n") / float(chunk)).alias("chunks"), F.sum("n").alias("total"))
    bins = sizes.filter("chunks = 1").agg(F.coalesce(F.ceil(F.sum("total") / float(chunk)), F.lit(1)).alias("bins"))
    placed = members.join(sizes.drop("total"), "component").crossJoin(F.broadcast(bins))
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("key"), "chunks")).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))
    )
    small = F.col("chunks") == 1
    return (
        placed.select(
            F.when(small, F.lit(-1)).otherwise(F.col("component")).alias("cluster"),
            F.when(small, F.pmod(F.xxhash64("component"), 4 * F.col("bins"))).otherwise(F.least("chunk", "other")).alias("x"),
            F.when(small, F.lit(0)).otherwise(F.greatest("chunk", "other")).alias("y"),
            "key",
            "n",
            "chunk",
            "shingles",
        )
        .groupBy("cluster", "x", "y")
        .applyInPandas(_linked(percent), "a bigint, b bigint")
    )


def _named(rows: DataFrame, names: DataFrame, on: str) -> DataFrame:
    """``rows`` joined with ``names``, one row for each value of ``on``; values with ``HOT`` rows or more are not gathered.

    There is at most one such value for every ``HOT`` rows, so their names are few.
    """
    often = rows.groupBy(on).agg(F.count("*").alias("many")).filter(F.col("many") >= HOT).select(on)
    often = stored(names.join(often, on), "often")
    common = rows.join(broadcast_if_small(often), on)
    return rows.join(broadcast_if_small(often.select(on)), on, "left_anti").join(names, on).unionByName(common)


def _components(keyed: DataFrame, size: int, percent: int, bucket: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """key, n of every row of ``keyed`` (key, text), and key, component (its smallest key) of those with links."""
    total = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    counts = stored(
        _sent(keyed, size, max(1, -(-total * COUNTED // (48 * bucket))))
        .groupBy("bucket")
        .applyInPandas(_shared, "key bigint, n bigint, single bigint")
        .groupBy("key")
        .agg(F.max("n").alias("n"), F.sum("single").alias("single")),
        "counts",
    )
    candidates = counts.filter((F.col("n") > 0) & (F.col("single") <= F.col("n") - F.ceil(F.col("n") * percent / 100)))
    chosen = broadcast_if_small(candidates.select("key"))
    sets = stored(_candidate_sets(keyed.join(chosen, "key"), size), "sets")
    members = _named(sets, sets.groupBy("digest").agg(F.min("key").alias("first")), "digest")
    members = stored(members.select("key", "n", "first", F.when(F.col("key") == F.col("first"), F.col("shingles")).alias("shingles")), "classes")
    links = _links(members.filter("key = first").select("key", "n", "shingles"), percent, chunk)
    copies = members.filter("key <> first").select(F.col("key").alias("a"), F.col("first").alias("b"))
    found = components(stored(links, "links").unionByName(copies))
    found = found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
    return counts.select("key", "n"), stored(found.withColumnRenamed("node", "key"), "components")


def join_components(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, bucket: int = BUCKET, chunk: int = CHUNK
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of each row of ``docs``."""
    ready(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("bigint"), "text")
    keyed = stored(rows, "keyed", "zstd")
    counts, found = _components(keyed.select("key", "text"), size, percent, bucket, chunk)
    ids = counts.join(keyed.select("key", "doc_id"), "key").join(found, "key", "left")
    ids = stored(ids, "ids")
    linked = ids.filter("component is not null")
    named = _named(linked, linked.groupBy("component").agg(F.min("doc_id").alias("component_id")), "component")
    alone = ids.filter("component is null").withColumn("component_id", F.col("doc_id"))
    return alone.unionByName(named).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def first_of_each(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, bucket: int = BUCKET, chunk: int = CHUNK
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, and of the smallest hash among these.

    Rows without a doc_id come last. Rows that are linked with nothing all stay, whatever their ids.
    """
    ready(docs.sparkSession)
    whole = docs.select(F.monotonically_increasing_id().alias("key"), F.struct("*").alias("whole"))
    keyed = stored(whole.withColumn("tie", F.xxhash64("whole")), "keyed", "zstd")
    _, found = _components(keyed.select("key", "whole.text"), size, percent, bucket, chunk)
    doc_id = F.col("whole.doc_id").alias("doc_id")
    place = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "tie", "key")
    linked = keyed.select("key", doc_id, "tie").join(found, "key")
    kept = linked.groupBy("component").agg(F.min(place)["key"].alias("key")).select("key")
    dropped = stored(found.join(kept, "key", "left_anti").select("key"), "dropped")
    return keyed.join(broadcast_if_small(dropped), "key", "left_anti").select("whole.*")
