"""Approximate nearest neighbours by NN-descent and greedy graph search, a shard of vectors at a time.

The shards: a random projection tree (fitted on a bounded sample of ``SAMPLE`` vectors; every vector is indexed) deals all
distinct vectors into shards of some ``SHARD`` vectors that are near each other. Leaves that the sample left too large are dealt out
further. A query visits the shards nearest to it: ``visits_of`` the number of vectors, all shards up to 16.

The graph: in its shard, every vector keeps its ``NEIGHBOURS`` nearest known ones. They are first sought in the leaves of
small trees, then NN-descent improves them: each vector looks at neighbours of its neighbours, of those that have it as
neighbour, and at a few random vectors, until a round finds few new ones.

The search: a query starts in each shard at the best of ``ENTRIES`` vectors and expands the best vectors found, ``WIDTH`` of them,
until all of these are expanded. Graph and search compare unit vectors in single precision; the best found are measured again
and ranked in double precision on the original vectors. Vectors are shuffled once, to their shard, and queries once for each shard
that they visit; all hops of a visit are one task's.

Equal vectors are one node; their smallest ids are found through it, so a vector that a third of all rows
share costs no more than any other. Vectors that are null, empty, zero or hold null or non-finite components take no
part, nor do vectors of another length than most, nor rows with null ``vec_id``. Repeated rows count once. With no more
vectors than ``ENTRIES`` the search is exact. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendmark.llm.common import ready, stored

NEIGHBOURS = 20
SAMPLE = 8192
SHARD = 4096
#: Small trees within a shard that give the first neighbours, and the vectors in a leaf of them.
TREES, LEAF = 8, 256
#: Rounds go on until fewer than this share of all pairs are new in one.
CHANGES = 0.03
#: In a round a vector looks at ``PICK`` neighbours of each of ``PICK`` neighbours, and at some random vectors.
PICK, STRANGERS = 10, 4
#: The beam, over all shards, up to ``BEAM_FITS`` vectors; more need a wider one.
BEAM, BEAM_FITS = 256, 51_282
#: The beam in one shard, where it starts, and how much of it is expanded at once.
WIDTH, ENTRIES, STEP = 96, 256, 8
#: Of each visit, and then of each query, so many are kept to be measured again.
KEPT = 32


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) of the rows that take part."""
    value = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0)
    rows = vectors.filter(F.col("vec_id").isNotNull() & fine).select("vec_id", value.alias("embedding"))
    length = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("embedding") == (length["d"] if length else 0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def unit_rows(batch: pa.RecordBatch, column: str = "embedding") -> np.ndarray:
    """A list column as a matrix of unit rows in single precision, or the rows packed."""
    if pa.types.is_binary(batch.schema.field(column).type):
        packed = b"".join(batch.column(column).to_pylist())
        return np.frombuffer(packed, np.float32).reshape(batch.num_rows, -1)
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
    values /= np.abs(values).max(axis=1, keepdims=True)
    return (values / np.linalg.norm(values, axis=1, keepdims=True)).astype(np.float32)


def _tree(sample: np.ndarray, leaves: int, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Splits of a balanced tree, one level after another, each across two of the sample's vectors, in half by its median."""
    place, splits = np.zeros(len(sample), np.int64), []
    for level in range(max(0, int(np.ceil(np.log2(max(1, leaves)))))):
        planes, cut = np.zeros((1 << level, sample.shape[1]), np.float32), np.zeros(1 << level, np.float32)
        for node in np.unique(place):
            here = np.flatnonzero(place == node)
            plane = np.subtract(*sample[rng.choice(here, 2, replace=len(here) < 2)])
            planes[node] = plane / max(1e-9, np.linalg.norm(plane))
            cut[node] = np.median(sample[here] @ planes[node])
        splits.append((planes, cut))
        place = 2 * place + (np.einsum("ij,ij->i", sample, planes[place]) > cut[place])
    return splits


def _leaf(rows: np.ndarray, splits: list) -> np.ndarray:
    place = np.zeros(len(rows), np.int64)
    for planes, cut in splits:
        place = 2 * place + (np.einsum("ij,ij->i", rows, planes[place]) > cut[place])
    return place


def _leaves(rows: np.ndarray, splits: list, count: int) -> np.ndarray:
    """The ``count`` leaves nearest to each row: those that the least has to be crossed for."""
    across = np.zeros((len(rows), 1), np.float32)
    for planes, cut in splits:
        beyond = rows @ planes.T - cut
        across = np.stack((across + np.maximum(beyond, 0) ** 2, across + np.maximum(-beyond, 0) ** 2), 2).reshape(len(rows), -1)
    return np.argsort(across, axis=1, kind="stable")[:, :count]


def _merged(ids: np.ndarray, sim: np.ndarray, more: np.ndarray, near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of each row's two lists, none of them twice."""
    ids, sim = np.concatenate((ids, more), 1), np.concatenate((sim, near), 1)
    order = np.argsort(ids, axis=1, kind="stable")
    ids, sim = np.take_along_axis(ids, order, 1), np.take_along_axis(sim, order, 1)
    sim[:, 1:][ids[:, 1:] == ids[:, :-1]] = -2
    best = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    return np.take_along_axis(ids, best, 1), np.take_along_axis(sim, best, 1)


def _seeds(unit: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest of each vector in its leaves of some small trees."""
    n = len(unit)
    depth = max(0, int(np.ceil(np.log2(n / LEAF))))
    size = -(-n // (1 << depth))
    idx, sim = np.zeros((n, 0), np.int32), np.zeros((n, 0), np.float32)
    for _ in range(TREES if depth else 1):
        order = np.resize(rng.permutation(n), size << depth)[None]
        for _ in range(depth):
            plane = unit[order[:, 0]] - unit[order[:, 1]]
            order = np.take_along_axis(order, np.argsort((unit[order] @ plane[:, :, None])[..., 0], axis=1), 1).reshape(2 * len(order), -1)
            order = rng.permuted(order, axis=1)
        block = unit[order]
        near = block @ block.transpose(0, 2, 1)
        near[order[:, :, None] == order[:, None, :]] = -2
        best = np.argpartition(-near, k - 1, axis=2)[:, :, :k]
        ids, value = np.empty((n, k), np.int32), np.empty((n, k), np.float32)
        ids[order] = np.take_along_axis(np.broadcast_to(order[:, None, :], near.shape), best, 2)
        value[order] = np.take_along_axis(near, best, 2)
        idx, sim = _merged(idx, sim, ids, value, k)
    return idx, sim


def _reverse(idx: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Of those that have a vector as neighbour, as many as it has itself, the least ``key`` first; filled up with its own."""
    n, k = idx.shape
    order = np.lexsort((key.ravel(), idx.ravel()))
    v, u = idx.ravel()[order], np.repeat(np.arange(n, dtype=idx.dtype), k)[order]
    place = np.arange(len(v)) - np.searchsorted(v, np.arange(n))[v]
    out = idx.copy()
    out[v[place < k], place[place < k]] = u[place < k]
    return out


def descend(unit: np.ndarray, seed: int = 11) -> np.ndarray:
    """Links of a shard's vectors: neighbours by NN-descent, and the nearest of those that have it as neighbour."""
    rng, n = np.random.default_rng(seed), len(unit)
    k = min(NEIGHBOURS, n - 1)
    if k < 1:
        return np.zeros((n, 1), np.int32)
    (idx, sim), rows = _seeds(unit, k, rng), np.arange(n)[:, None]
    changed = n * k if n > LEAF else 0
    while changed > CHANGES * n * k:
        pool = np.concatenate((idx, _reverse(idx, rng.random(idx.shape))), 1)
        one, two = (pool[rows, rng.integers(0, 2 * k, (n, PICK))] for _ in range(2))
        reached = np.concatenate((two[one].reshape(n, -1), rng.integers(0, n, (n, STRANGERS), np.int32)), 1)
        near = np.concatenate([(unit[reached[a : a + 256]] @ unit[a : a + 256, :, None])[..., 0] for a in range(0, n, 256)])
        near[reached == rows] = -2
        worst = sim.min(1, keepdims=True)
        had = (sim > worst).sum()
        idx, sim = _merged(idx, sim, reached, near, k)
        changed = (sim > worst).sum() - had
    return np.concatenate((idx, _reverse(idx, -sim)), 1)


def greedy(unit: np.ndarray, links: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best vectors that the search of each unit row of ``asked`` ends with, and how near; -3 is none."""
    entry = np.unique(np.linspace(0, len(unit) - 1, ENTRIES).astype(np.int32))
    seen = np.zeros((len(asked), len(unit)), bool)
    seen[:, entry] = True
    pad = ((0, 0), (0, max(0, WIDTH - len(entry))))
    near = np.pad(asked @ unit[entry].T, pad, constant_values=-3)
    ids = np.pad(np.broadcast_to(entry, (len(asked), len(entry))), pad)
    state = (ids, near, near > -3)

    def best() -> tuple[np.ndarray, ...]:
        place = np.argpartition(-state[1], WIDTH - 1, axis=1)[:, :WIDTH]
        return tuple(np.take_along_axis(x, place, 1) for x in state)

    state, active = best(), np.arange(len(asked))
    found, value = np.zeros((len(asked), WIDTH), np.int32), np.full((len(asked), WIDTH), -3, np.float32)
    while len(active):
        ids, near, fresh = state
        step = np.argpartition(np.where(fresh, -near, 9), STEP - 1, axis=1)[:, :STEP]
        open_ = np.take_along_axis(fresh, step, 1)
        np.put_along_axis(fresh, step, False, 1)
        reached = links[np.take_along_axis(ids, step, 1)]
        reached = np.where(open_[:, :, None], reached, entry[0]).reshape(len(active), -1)
        reached.sort(axis=1)
        new = ~seen[active[:, None], reached]
        new[:, 1:] &= reached[:, 1:] != reached[:, :-1]
        row, column = np.nonzero(new)
        node = reached[row, column]
        seen[active[row], node] = True
        sim = np.full(reached.shape, -3, np.float32)
        sim[row, column] = np.einsum("ij,ij->i", unit[node], asked[active[row]])
        state = tuple(np.concatenate(x, 1) for x in zip((ids, near, fresh), (reached, sim, new)))
        state = best()
        ended = ~state[2].any(1)
        found[active[ended]], value[active[ended]] = state[0][ended], state[1][ended]
        active, state = active[~ended], tuple(x[~ended] for x in state)
    return found, value


def packed_units(nodes: DataFrame) -> DataFrame:
    """node and its unit vector in single precision, which is what graph and search compare."""
    ready(nodes.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [row.tobytes() for row in unit_rows(batch)] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(units, pa.binary())], ["node", "unit"])

    return stored(nodes.mapInArrow(pack, "node bigint, unit binary"), "units")


def beam_of(count: int) -> int:
    """The beam for ``count`` vectors. Five times the vectors took three times the beam for a recall of 0.96."""
    return int(np.ceil(BEAM * max(1.0, count / BEAM_FITS) ** 0.75))


def visits_of(count: int) -> int:
    """The shards that a query visits among ``count`` vectors: one for every 16 of the beam."""
    return -(-beam_of(count) // 16)


def dealt(packed: DataFrame, queries: DataFrame, seed: int = 11) -> DataFrame:
    """shard, asks, node, unit: every vector of ``packed`` in its shard, and ``queries`` (node, unit) in those that they visit."""
    rng = np.random.default_rng(seed)
    count = packed.count()
    sample = packed.orderBy(F.xxhash64(F.lit(seed), "node"), "node").limit(SAMPLE).select("unit").toArrow()
    sample = unit_rows(sample.combine_chunks().to_batches()[0], "unit") if count else np.zeros((0, 1), np.float32)
    splits = _tree(sample, min(-(-count // SHARD), max(1, len(sample) // 8)), rng)
    tree, visits = packed.sparkSession.sparkContext.broadcast(splits), visits_of(count)

    def placed(asks: bool):
        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 1024):
                    piece = batch.slice(a, 1024)
                    rows = unit_rows(piece, "unit")
                    leaves = _leaves(rows, tree.value, visits) if asks else _leaf(rows, tree.value)[:, None]
                    for leaf in leaves.T:
                        yield pa.RecordBatch.from_arrays([pa.array(leaf), *(piece.column(c) for c in ("node", "unit"))], ["leaf", "node", "unit"])

        return place

    members = packed.mapInArrow(placed(False), "leaf bigint, node bigint, unit binary")
    # Leaves that the sample's tree left too large are dealt out further; a query visits all parts of a leaf.
    sizes = F.broadcast(members.groupBy("leaf").agg(F.ceil(F.count("*") / (2.0 * SHARD)).alias("parts")))
    part = F.pmod(F.xxhash64(F.lit(seed), "node"), "parts")
    members = members.join(sizes, "leaf").select(F.xxhash64("leaf", part).alias("shard"), F.lit(False).alias("asks"), "node", "unit")
    asking = queries.mapInArrow(placed(True), "leaf bigint, node bigint, unit binary").join(sizes, "leaf")
    asking = asking.select("leaf", "node", "unit", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    asking = asking.select(F.xxhash64("leaf", "part").alias("shard"), F.lit(True).alias("asks"), "node", "unit")
    # More partitions than shards, as few as there are, so that adaptive execution does not put all of them in one task.
    tasks = min(4096, 3 * -(-count // SHARD) + 1)
    return members.unionByName(asking).repartition(tasks, "shard").sortWithinPartitions("shard", "asks", "node")


def search_shards(visits: DataFrame) -> DataFrame:
    """query, node, near: the best ``KEPT`` that each query's search of a shard (see ``dealt``) has found."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, unit = None, [], None
        for batch in batches:
            key, asks = batch.column("shard").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(key) != 0) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows]):
                if a == b:
                    continue
                if key[a] != shard:
                    shard, held, unit = key[a], [], None
                if not asks[a]:
                    held.append(batch.slice(a, b - a))
                    continue
                if not held:
                    continue
                if unit is None:
                    unit = np.concatenate([unit_rows(piece, "unit") for piece in held])
                    node = np.concatenate([piece.column("node").to_numpy() for piece in held])
                    links = descend(unit)
                for c in range(a, b, 512):
                    piece = batch.slice(c, min(512, b - c))
                    ids, near = greedy(unit, links, unit_rows(piece, "unit"))
                    order = np.lexsort((node[ids], -near))[:, :KEPT]
                    ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
                    real = near > -3
                    query = np.broadcast_to(piece.column("node").to_numpy()[:, None], ids.shape)[real]
                    yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(node[ids[real]]), pa.array(near[real])], ["query", "node", "near"])

    return visits.mapInArrow(visit, "query bigint, node bigint, near float")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every query among all other vectors."""
    rows = stored(valid(vectors).dropDuplicates(["vec_id"]), "vectors")
    named = rows.join(rows.groupBy("embedding").agg(F.min("vec_id").alias("node")), "embedding")
    named = stored(named.select("vec_id", "node", F.when(F.col("vec_id") == F.col("node"), F.col("embedding")).alias("embedding"), is_query.alias("asks")), "nodes")
    nodes = named.filter("vec_id = node").select("node", "embedding")
    packed = packed_units(nodes)
    # Queries with equal vectors are one search.
    asking = named.filter("asks").select("node").distinct()
    found = search_shards(dealt(packed, packed.join(asking, "node")))
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("near"), "node"))
    found = found.withColumn("place", best).filter(F.col("place") <= KEPT).select("query", "node")
    # Copies of a query's own vector are found through it in any case.
    found = stored(found.unionByName(asking.select(F.col("node").alias("query"), "node")).distinct(), "found")
    # What single precision calls near is measured again on the original vectors.
    # Vectors are first brought near 1 by a power of two, which is exact, so that no square vanishes or overflows.
    power = F.floor(F.log2(F.array_max(F.transform("embedding", F.abs))))
    near_one = F.pow(F.lit(2.0), F.greatest(F.least(-power, F.lit(1000)), F.lit(-1000)).cast("double"))
    scaled = nodes.withColumn("_scale", near_one).select("node", F.transform("embedding", lambda x: x * F.col("_scale")).alias("embedding"))
    norm = F.sqrt(dot(F.col("embedding"), F.col("embedding")))
    measured = scaled.select("node", "embedding", norm.alias("norm"))
    wanted = measured.join(asking, "node").select(F.col("node").alias("query"), F.col("embedding").alias("wanted"), F.col("norm").alias("length"))
    score = dot(F.col("wanted"), F.col("embedding")) / (F.col("length") * F.col("norm"))
    found = found.join(measured, "node").join(wanted, "query").select("query", "node", score.alias("score"))
    top = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "node"))
    found = found.withColumn("place", top).filter(F.col("place") <= k + 1)
    copy = F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))
    copies = named.select("node", "vec_id").withColumn("copy", copy).filter(F.col("copy") <= k + 1)
    first = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    lists = found.join(copies, "node").withColumn("place", first).filter(F.col("place") <= k + 1).select("query", "vec_id", "score")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        named.filter("asks")
        .select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
        .join(lists, "query")
        .filter("query_id <> vec_id")
        .select("query_id", rank.cast("int").alias("rank"), "vec_id", "score")
        .filter(F.col("rank") <= k)
    )
