"""Chat formatting with Spark expressions only.

A conversation becomes one text. Its turns are collected as structs and sorted; neighbours of one role become
one block. Markers are ``<|turn:ROLE|>``, ``<|and|>`` between two turns of a block, and ``<|end|>`` after it.
Inside texts and roles ``&``, ``<|`` and ``|>`` are escaped, so that no text can write a marker and the
formatted text can be read back without loss.

Null text or role: empty. Turns sort by (turn, role, text), nulls first; repeated rows stay. A null
``conv_id`` is one conversation of its own. Other columns are ignored. An empty table gives no rows.
A conversation is the unit of the output, so it must fit in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>"
AND = "<|and|>"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<|", "&lt;|"), ("|>", "|&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for safe, raw in (("&gt;", ">"), ("&lt;", "<"), ("&amp;", "&")):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def _blocks(turns: Column) -> Column:
    """Sorted turns as an array of arrays, one for each run of equal roles."""
    first = F.filter(
        F.sequence(F.lit(0), F.size(turns) - 1),
        lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]),
    )
    ends = F.concat(F.slice(first, 2, F.size(turns)), F.array(F.size(turns)))
    return F.transform(
        F.arrays_zip(first.alias("begin"), ends.alias("end")),
        lambda b: F.slice(turns, b["begin"] + 1, b["end"] - b["begin"]),
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, formatted, loss_runs.

    ``loss_runs`` is the loss mask of ``formatted`` in runs of characters: each has a number of ``chars``
    and whether they count (``loss``). Only texts of the role ``assistant`` count, never their markers.
    """
    turn = F.struct(
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    sorted_turns = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def run(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def pieces(block: Column) -> Column:
        role = F.get(block, F.lit(0))["role"]
        texts = F.transform(
            block,
            lambda t, i: F.array(
                run(
                    F.when(i == 0, F.concat(F.lit("<|turn:"), escape(role), F.lit("|>"))).otherwise(F.lit(AND)),
                    F.lit(False),
                ),
                run(escape(t["text"]), role == TRAINED),
            ),
        )
        return F.concat(F.flatten(texts), F.array(run(F.lit(END), F.lit(False))))

    return (
        sorted_turns.select("conv_id", _blocks(F.col("turns")).alias("blocks"))
        .select("conv_id", F.flatten(F.transform("blocks", pieces)).alias("pieces"))
        .select(
            "conv_id",
            F.array_join(F.col("pieces")["text"], "").alias("formatted"),
            F.transform(
                "pieces", lambda p: F.struct(F.char_length(p["text"]).alias("chars"), p["loss"].alias("loss"))
            ).alias("loss_runs"),
        )
    )


def read_conversations(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text), read from ``formatted`` alone."""
    blocks = F.filter(F.split("formatted", r"<\|end\|>"), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = unescape(F.substring(F.substring_index(block, "|>", 1), 8, 1 << 30))
        body = F.substring(block, F.locate("|>", block) + 2, 1 << 30)
        return F.transform(
            F.split(body, r"<\|and\|>", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text"))
        )

    return formatted.withColumn("turns", F.flatten(F.transform(blocks, turns)))


#: Runs of a mask that are cut out of their stretch of text together, so that no cut scans the whole text.
_STRETCH = 256


def _starts(sizes: Column) -> Column:
    """Running sums of ``sizes``, from 0."""
    return F.aggregate(
        F.slice(sizes, 1, F.greatest(F.size(sizes) - 1, F.lit(0))),
        F.array(F.lit(0).cast("bigint")),
        lambda sums, n: F.concat(sums, F.array(F.element_at(sums, -1) + n)),
    )


def _sum(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0).cast("bigint"), lambda n, x: n + x)


def masked_texts(formatted: DataFrame) -> DataFrame:
    """Adds ``loss_texts``: what ``loss_runs`` marks in ``formatted``, run by run, unescaped."""
    stretches = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size("loss_runs") - 1) / _STRETCH).cast("int"), F.lit(0))),
        lambda i: F.slice("loss_runs", i * _STRETCH + 1, _STRETCH),
    )
    rows = formatted.withColumn("_stretches", stretches)
    rows = rows.withColumn("_sizes", F.transform("_stretches", lambda runs: _sum(runs["chars"])))
    rows = rows.withColumn("_begin", _starts(F.col("_sizes")))
    cut = F.transform(
        "_stretches",
        lambda runs, i: F.struct(
            F.substring("formatted", (F.get("_begin", i) + 1).cast("int"), F.get("_sizes", i).cast("int")).alias("text"),
            F.arrays_zip(runs.alias("run"), _starts(runs["chars"]).alias("at")).alias("runs"),
        ),
    )
    rows = rows.withColumn("_cut", cut)
    marked = F.transform(
        "_cut",
        lambda own: F.transform(
            F.filter(own["runs"], lambda r: r["run"]["loss"]),
            lambda r: unescape(F.substring(own["text"], (r["at"] + 1).cast("int"), r["run"]["chars"])),
        ),
    )
    return rows.withColumn("loss_texts", F.flatten(marked)).drop("_stretches", "_sizes", "_begin", "_cut")


def fingerprints(formatted: DataFrame) -> DataFrame:
    """Digests of what can be read back from the formatted texts, and of what the loss mask marks in them."""
    back = masked_texts(read_conversations(formatted))
    joined = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = F.array_join("loss_texts", "")
    masked = F.aggregate("loss_runs", F.lit(0).cast("bigint"), lambda n, r: n + F.when(r["loss"], r["chars"]).otherwise(0))
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
        masked.alias("mask_chars"),
    )
