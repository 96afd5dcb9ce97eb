"""One query for each operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmark.llm import alignment, chat, decontaminate, language, lexical, mixing, nearest, ngram_join, packing, quality, recurrent, token_counts, wavelet
from trendmark.llm.common import learning_row, table
from trendmark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent.score_documents(table(spark, sf_dir, "documents"), learning_row("doc_id", 7, 2))


@query
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A conversation whose texts are themselves control strings of a chat template.
    control = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.fingerprints(chat.format_conversations(conversations.unionByName(control)))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.judged(found).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


@query
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(table(spark, sf_dir, "documents"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def token_shards(docs: DataFrame) -> DataFrame:
    target = scratch_path(docs.sparkSession, "shards")
    wavelet.write_shards(docs, target, public_tokenizers.path("word_bpe_49k.json"))
    return wavelet.read_documents(docs.sparkSession, target)


@query
def op10_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards(table(spark, sf_dir, "documents"))


@query
def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learns = learning_row("doc_id", 5, 0)
    model = quality.learn(documents, labels.filter(learns))
    return quality.score(documents.withColumn("held_out", ~learns), model, ["doc_id", "held_out"]).withColumn(
        "predicted", quality.accepted().cast("int")
    )


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@query
def op11_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte, piece = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = alignment.Alignment(table(spark, sf_dir, "documents"), byte, piece)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    rows = aligned.groups().withColumn("groups_sha256", digest).drop("groups")
    return aligned.with_counts(rows)


@query
def op12_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=1)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_ESCAPED = "replace(replace(replace(coalesce({0}, ''), '&', '&amp;'), '<|', '&lt;|'), '|>', '|&gt;')"

ORACLE["op2_chat_format"] = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
turns AS (
    SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) <> role, TRUE) AS opens,
           length({_ESCAPED.format("role")}) AS role_chars, length({_ESCAPED.format("text")}) AS text_chars
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(text_chars + CASE WHEN opens THEN role_chars + 9 + 7 ELSE 7 END)::BIGINT AS formatted_chars,
       coalesce(sum(text_chars) FILTER (role = 'assistant'), 0)::BIGINT AS mask_chars
FROM turns GROUP BY conv_id
"""

ORACLE["op4_decontaminate"] = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
items AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
windows AS (
    SELECT DISTINCT item, n, array_to_string(words[i:i + n - 1], ' ') AS written
    FROM (SELECT item, words, least(len(words), 13) AS n, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM items WHERE len(words) > 0)
),
places AS (
    SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS written
    FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n)
),
found AS (SELECT doc_id, item, i, n FROM places JOIN windows USING (n, written)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLE["op8_ngram_join"] = f"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM docs WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS one, b.doc_id AS other, count(*) AS common
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
    SELECT one, other FROM shared JOIN sizes a ON one = a.doc_id JOIN sizes b ON other = b.doc_id
    WHERE 100 * common >= 75 * (a.n + b.n - common)
),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT reached.doc_id, links.other FROM reached JOIN links ON reached.other = links.one
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE["op13_lexical_search"] = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents),
held AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) GROUP BY row, term),
sizes AS (SELECT row, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0),
totals AS (SELECT count(*)::BIGINT AS documents, sum(n)::BIGINT AS occurrences FROM sizes),
asked AS (
    SELECT item_id, term, count(*) AS repeats
    FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term
),
weights AS (
    SELECT term, floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM held, totals WHERE term IN (SELECT term FROM asked) GROUP BY term, documents
),
impacts AS (
    SELECT doc_id, row, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * documents) // occurrences)) AS impact
    FROM held JOIN sizes USING (row), totals
),
scored AS (
    SELECT item_id, row, doc_id, sum(repeats * w * impact)::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item_id, row, doc_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 20
"""
