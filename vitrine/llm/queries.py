"""One query per operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.llm import (alignment, chat, decontaminate, fingerprint, language, maintext, mixing, neardup, negatives, partenum, quality, simple8b,
                         substrings)
from vitrine.llm import common as C
from vitrine.session import shared_folder


def op1_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = C.table(spark, folder, "pages")
    return maintext.extract(pages, maintext.fit(pages))


def op2_near_groups(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_components(C.table(spark, folder, "documents"), width=3, percent=85)


def quality_network(spark: SparkSession, docs: DataFrame, folder: str) -> quality.Network | None:
    """Learned from the labels of ``folder``, but for the held-out fifth of ids."""
    labels = C.table(spark, folder, "labels")
    return quality.fit(docs, labels.filter(C.remainder("doc_id", 5) != 0))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = C.table(spark, folder, "documents").select("doc_id", "text")
    network = quality_network(spark, docs, folder)
    return quality.score(docs, network).select(
        "doc_id", (C.remainder("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = C.table(spark, folder, "documents")
    return mixing.mix(docs, C.words("text")).select(
        "doc_id", "size", "source", "source_size", "target", "copies", "tail", "taken")


def token_file(docs: DataFrame) -> DataFrame:
    import public_tokenizers
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    simple8b.write_blocks(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return simple8b.read_digests(spark, path)


def op5_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return token_file(C.table(spark, folder, "documents").select("doc_id", "text"))


def op6_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(C.table(spark, folder, "documents"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = C.table(spark, folder, "documents")
    held_out = C.remainder("doc_id", 4) == 2
    models = language.learn(docs.filter(~held_out).select("text", "lang"))
    return language.identify(docs.select("doc_id", "text"), models).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.render(C.table(spark, folder, "conversations"))


OP8_SQL = r"""
WITH placed AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place
                FROM conversations),
said AS (SELECT *, '<|' || coalesce(role, 'user') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS line
         FROM placed),
runs AS (SELECT conv_id, place, string_agg(line, '' ORDER BY place) OVER (PARTITION BY conv_id ORDER BY place
             ROWS UNBOUNDED PRECEDING) AS chat,
             count(*) OVER (PARTITION BY conv_id) AS n_turns FROM said),
whole AS (SELECT min(conv_id) AS conv_id, n_turns, chat FROM runs WHERE place = n_turns GROUP BY n_turns, chat)
SELECT conv_id, CAST(0 AS BIGINT) AS part, n_turns, chat FROM whole w
WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.place < r.n_turns AND r.place = w.n_turns AND r.chat = w.chat)
"""


def op9_contaminated(spark: SparkSession, folder: str) -> DataFrame:
    docs = C.table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, C.table(spark, folder, "benchmark")).select(
        "doc_id", "contaminated", "item_id", "overlap")


def op10_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprints(C.table(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = C.table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(negatives.clean(rows, label), F.col("vec_id") % 50 == 0)


OP11_SQL = """
WITH rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                     list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
              FROM embeddings
              WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
                 CAST(coalesce(list_sum(list_transform(list_zip(a.vector, b.vector), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
          FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.vector) = len(b.vector)),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE alike
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
found AS (SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS rank
          FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.alike
              AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM found WHERE rank <= 3
"""


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers
    docs = C.table(spark, folder, "documents")
    found = alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return partenum.jaccard_components(C.table(spark, folder, "documents"), width=5, percent=80)


QUERIES = {
    "op1_main_text": (op1_main_text, None),
    "op2_near_groups": (op2_near_groups, None),
    "op3_quality": (op3_quality, None),
    "op4_mix": (op4_mix, None),
    "op5_token_ids": (op5_token_ids, None),
    "op6_repeats": (op6_repeats, None),
    "op7_language": (op7_language, None),
    "op8_chat": (op8_chat, OP8_SQL),
    "op9_contaminated": (op9_contaminated, None),
    "op10_fingerprint": (op10_fingerprint, None),
    "op11_hard_negatives": (op11_hard_negatives, OP11_SQL),
    "op12_alignment": (op12_alignment, None),
    "op13_jaccard_join": (op13_jaccard_join, None),
}
