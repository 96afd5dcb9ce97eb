"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target of words; a document's fractional number of copies is its source's target over
the source's size. Two documents of a source meet: one hands words to the other until one of the two has a
whole number of copies, in the direction chosen by a coin weighted so that expected copies stay as they
were. Words handed over are words received, so a source's sum stays at its target. Documents meet in small
groups; each group leaves one unfinished document at most, and these meet in the next, smaller round: a
reduction tree. In its last round they meet some documents of every magnitude, the largest first, so that
what remains at last is a small document; that one is rounded by a coin, and a source misses its target by
less than the size of one document.

Coins are hashes of seed, round and document, so reruns agree and a lost task is repeated with the same
result. Null texts have no words; null sources are one source, sorted last. Documents without words take
nothing. Repeated rows are documents of their own. Other columns pass through ``mix`` unread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendmark.llm.common import stored

#: Documents that meet in one group.
GROUP = 32
#: No document is taken more often than this, and no target exceeds this many times its source's size.
MOST = 2.0
#: Fractions this near to a whole number are whole.
NEAR = 1e-9
#: Documents of each source and magnitude (power of two of the size) that meet last.
RESERVE = 8


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]++")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """source, source_size, documents, target: sources weigh ``weights`` in turn and share ``share`` of all words.

    A target above ``MOST`` times its source's size stops there; the excess goes to the others by weight.
    With t the common level, target = min(cap, weight * t): sources fill in the order of cap / weight, so
    running sums give t without repeating rounds. There is one row for each source here.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.get(F.array(*map(F.lit, map(float, weights))), F.pmod(place - 1, F.lit(len(weights))))
    capped = (
        by_source.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * MOST)
        .withColumn("fills_at", F.col("cap") / F.col("weight"))
    )
    order = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    full_before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(full_before), F.lit(0.0))) / (
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    )
    # The level holds at the first source that it does not fill; where there is none, all are full.
    holds = F.when(F.col("level") <= F.col("fills_at"), F.struct("fills_at", "level"))
    return (
        capped.withColumn("level", level)
        .withColumn("common", F.min(holds).over(everything)["level"])
        .select(
            "source",
            "source_size",
            "documents",
            F.least("cap", F.col("weight") * F.coalesce("common", F.lit(float("inf")))).alias("target"),
        )
    )


def _coin(seed: int, level: int, *keys: Column) -> Column:
    """Uniform in [0, 1), a function of the keys."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(level), *keys), F.lit(1 << 52)).cast("double") / float(1 << 52)


def _meet(seed: int, level: int) -> Column:
    """One group's documents, one after another against the unfinished one.

    The accumulator holds the finished documents and the unfinished one (``left``, null if there is none).
    """
    kind = "struct<done: array<struct<row: bigint, part: int, copies: double, size: bigint>>, left: struct<row: bigint, part: int, copies: double, size: bigint>>"
    start = F.from_json(F.lit('{"done": []}'), kind)

    def member(of: Column, copies: Column) -> Column:
        return F.struct(of["row"].alias("row"), of["part"].alias("part"), copies.alias("copies"), of["size"].alias("size"))

    def whole(copies: Column) -> Column:
        return F.abs(copies - F.round(copies)) < NEAR

    def step(state: Column, new: Column) -> Column:
        old = state["left"]
        low_a, low_b = F.floor(old["copies"]), F.floor(new["copies"])
        a, b = old["copies"] - low_a, new["copies"] - low_b
        # Words that the old one can receive from the new one, and the other way round.
        to_old = F.least((1 - a) * old["size"], b * new["size"])
        to_new = F.least(a * old["size"], (1 - b) * new["size"])
        gain = F.when(_coin(seed, level, old["row"], old["part"], new["row"], new["part"]) * (to_old + to_new) < to_new, to_old).otherwise(-to_new)
        x, y = member(old, old["copies"] + gain / old["size"]), member(new, new["copies"] - gain / new["size"])
        met = F.filter(F.array(x, y), lambda m: ~whole(m["copies"]))
        done = F.concat(state["done"], F.filter(F.array(x, y), lambda m: whole(m["copies"])))
        # Should rounding errors leave both unfinished, the second is within such an error of whole.
        both = F.struct(F.concat(done, F.slice(met, 2, 1)).alias("done"), F.get(met, F.lit(0)).alias("left"))
        return F.when(old.isNull(), F.struct(state["done"].alias("done"), member(new, new["copies"]).alias("left"))).otherwise(both)

    members = F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("first"), "row", "part", "copies", "size")))
    return F.aggregate(members, start, lambda s, m: step(s, m).cast(kind))


def taken_words(sizes: DataFrame, seed: int = 7, weights: Sequence[float] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """``sizes`` (row, part, source, size; ``row`` and ``part`` name a document) with source_size, target, copies, taken."""
    sizes = stored(sizes, "sizes")
    targets = source_targets(sizes, weights, share).withColumnRenamed("source", "of")
    copies = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    planned = stored(
        sizes.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("copies", copies), "planned"
    )
    whole = F.abs(F.col("copies") - F.round("copies")) < NEAR
    finished = planned.filter(whole).select("row", "part", "copies")
    active = planned.filter(~whole).select("row", "part", "source", "copies", "size", "documents")
    magnitude = Window.partitionBy("source", F.floor(F.log2("size"))).orderBy(F.xxhash64("row", "part"), "row", "part")
    reserve = stored(
        active.withColumn("place", F.row_number().over(magnitude)).filter(F.col("place") <= RESERVE).drop("place"), "reserve"
    )
    active = active.join(reserve.select("row", "part"), ["row", "part"], "left_anti")
    level, largest = 0, planned.agg(F.max("documents")).first()[0] or 0
    while largest > 1:
        groups = F.ceil(F.col("documents") / float(GROUP ** (level + 1)))
        met = stored(
            active.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "row", "part"), groups))
            .groupBy("source", "bucket", "documents")
            .agg(_meet(seed, level).alias("met"))
            .select("source", "documents", "met.*"),
            f"met-{level}",
        )
        finished = finished.unionByName(met.select(F.inline("done")).select("row", "part", "copies"))
        active = met.filter("left is not null").select(
            "left.row", "left.part", "source", "left.copies", "left.size", "documents"
        )
        level, largest = level + 1, -(-largest // GROUP)
    met = stored(
        active.unionByName(reserve).groupBy("source").agg(_meet(seed, level).alias("met")).select("source", "met.*"), "met-last"
    )
    finished = finished.unionByName(met.select(F.inline("done")).select("row", "part", "copies"))
    active = met.filter("left is not null").select("left.row", "left.part", "left.copies")
    base = F.floor("copies")
    coin = F.when(_coin(seed, level, F.col("row"), F.col("part")) < F.col("copies") - base, 1).otherwise(0)
    finished = finished.unionByName(active.select("row", "part", (base + coin).cast("double").alias("copies")))
    return (
        planned.drop("copies", "documents")
        .join(finished.withColumn("copies", F.round("copies").cast("bigint")), ["row", "part"])
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def _row() -> Column:
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("row")


def _named(docs: DataFrame, *order: str) -> DataFrame:
    """``docs`` with ``row`` and ``part``, which tell rows of one doc_id apart; these are rare, most rows are part 1."""
    docs = docs.withColumn("row", _row())
    if docs.groupBy("row").count().filter("count > 1").isEmpty():
        return docs.withColumn("part", F.lit(1))
    return docs.withColumn("part", F.row_number().over(Window.partitionBy("row").orderBy(*order)))


def mix_sizes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of ``docs`` (doc_id, source, text)."""
    sizes = _named(docs.select("doc_id", "source", count_words(F.col("text")).alias("size")), "source", "size")
    return taken_words(sizes.select("doc_id", "row", "part", "source", "size"), **options).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row as often as the mix takes it."""
    named = _named(docs.select(F.struct("*").alias("whole"), "doc_id", "source", "text"), "source", "text", "whole")
    sizes = named.select("row", "part", "source", count_words(F.col("text")).alias("size"))
    copies = taken_words(sizes, **options).filter("copies > 0").select("row", "part", "copies")
    return (
        named.select("row", "part", "whole")
        .join(copies, ["row", "part"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select("whole.*")
    )
