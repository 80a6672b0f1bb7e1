"""Stages of the corpus pipeline; each takes (spark, docs, folder) and gives documents back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vitrine.llm import common as C, decontaminate, mixing, neardup, quality, queries
from vitrine.session import shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Least probability of good quality with which a document stays.
KEEP_SCORE = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Leaves out documents that the quality network rejects.

    Null and empty texts are scored as an empty chunk, repeated rows alike;
    where labels teach nothing all stay.  An empty table gives an empty table.
    Columns besides those of documents are left out.
    """
    docs = docs.select(*COLUMNS)
    network = queries.quality_network(spark, docs, folder)
    return quality.score(docs, network).filter(F.col("score") >= KEEP_SCORE).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group that shares 80 in 100 of its five-word shingles.

    Of repeated rows one stays.  Texts without words, null ones too, all stay;
    null ids come last in a group.  An empty table gives an empty table.
    """
    return neardup.keep_one(docs.select(*COLUMNS), width=5, percent=80).select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Leaves out documents that hold a benchmark item or a paraphrase of one.

    Null and empty texts stay, repeated rows are judged alike, and an empty
    benchmark leaves all.  An empty table gives an empty table.
    """
    benchmark = C.table(spark, folder, "benchmark")
    return decontaminate.contaminated(docs.select(*COLUMNS), benchmark).filter(~F.col("contaminated")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeats documents so that their sources reach their target weights.

    A document stays whole: it is there once per whole repetition, and once
    more if the fractional one takes at least half of it.  Null and empty texts
    have no words and stay out of or in the mix without weight; rows equal in
    all columns are counted apart.  An empty table gives an empty table.
    """
    keyed = docs.select(*COLUMNS, F.xxhash64("doc_id", "source", "text").alias("__key"))
    mixed = mixing.mix(keyed, C.words("text"), key="__key")
    more = F.when((F.col("tail") > 0) & (F.col("tail") * 2 >= F.col("size")), 1).otherwise(0)
    # Equal rows have one key; the n-th of them takes the n-th number.
    times = mixed.groupBy(F.col("doc_id").alias("__key")).agg(
        F.sort_array(F.collect_list((F.col("copies") + more).cast("int")), asc=False).alias("__times"))
    nth = F.row_number().over(Window.partitionBy("__key").orderBy("__key"))
    placed = keyed.join(times, "__key").withColumn("__n", nth)
    return (placed.withColumn("__again", F.explode(F.array_repeat(F.lit(1), F.element_at("__times", F.col("__n")))))
            .select(*COLUMNS))


def write_tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Writes the token ids of all documents and reads their digests back.

    A null or empty text is its end id alone, null ids come first, repeated
    rows are rows like others.  An empty table gives an empty table.
    """
    return queries.token_file(docs.select("doc_id", "text"))


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("leaks", drop_leaks),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]

#: A trained network and a randomised search are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each but the last written and read again."""
    docs = C.table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
