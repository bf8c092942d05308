"""The corpus pipeline: operators of ``vitrine.llm`` applied to documents one after another.

Every stage but the last returns the columns of ``documents``.  A text that a
stage shortens gets a new n_chars; a document that has no word left is gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.catalog import PIECE_MODEL
from vitrine.llm.contamination import decontaminate
from vitrine.llm.language import accepted, is_held_out, train
from vitrine.llm.pieces import encode
from vitrine.llm.repeated_bytes import remove_repeated_bytes
from vitrine.llm.similar_sets import first_of_groups
from vitrine.session import scratch_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter or far from every language go."""
    docs = docs.select(*COLUMNS)
    return accepted(docs, train(docs.filter(~is_held_out())))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of similar ones, the one with the smallest doc_id."""
    return first_of_groups(docs.select(*COLUMNS))


def suffix_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the 200-byte strings that occur more than once."""
    left = remove_repeated_bytes(docs, as_text=True, carry=("lang", "source", "n_chars"))
    return _shortened(left.withColumnRenamed("kept", "text"), F.col("n_removed") > 0)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the words of benchmark passages."""
    left = decontaminate(docs, spark.read.parquet(f"{folder}/benchmark.parquet"), carry=("lang", "source", "n_chars"))
    return _shortened(left.withColumnRenamed("kept_text", "text"), F.col("n_hit") > 0)


def sentencepiece(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of what is left."""
    return encode(docs, PIECE_MODEL)


def _shortened(docs: DataFrame, changed) -> DataFrame:
    """Documents' columns; changed texts with their new n_chars, if they still have a word."""
    return (
        docs.filter(~changed | F.col("text").rlike(r"[^ \x09-\x0D]"))
        .withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(*COLUMNS)
    )


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", ngram_jaccard),
    ("suffix-array dedup", suffix_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", sentencepiece),
]

# Neither the language nor the tokens can be had in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Each stage on what its predecessor has written, beginning with documents."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    home = scratch_folder(spark, "corpus")
    for number, (_, stage) in enumerate(STAGES):
        target = f"{home}/{number}"
        stage(spark, docs, folder).write.parquet(target)
        docs = spark.read.parquet(target)
    return docs
